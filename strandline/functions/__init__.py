from strandline.functions.columns import (  # noqa: F401
    BATCH_ID, INGESTION_TIME, RESCUED, SOURCE_FILE,
    capture, cast_to_contract, clear_rescued, lineage, recover, rescued_filter,
    rescued_map, to_type,
)
