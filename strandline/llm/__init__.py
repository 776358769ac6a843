"""Training-data operators: scans, filters, deduplication, mixing and output
for text corpora, each a DataFrame -> DataFrame function.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports
it; ``__spark_entry__`` registers its queries when it can be imported.
"""
