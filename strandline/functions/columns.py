"""Column builders and pure DataFrame -> DataFrame transforms.

Everything here is a single ``select`` over built-in expressions, so it
stays inside whole-stage codegen, adds no shuffle, and works the same on a
batch DataFrame, a streaming micro-batch or a repair projection.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.fit import (ENTRIES, castable, conform, held, misfit, parsed, restore, root,
                                      text_of)
from strandline.functions.lattice import is_nested, relaxed

RESCUED = "_rescued_data"
SOURCE_FILE = "_source_file"
INGESTION_TIME = "_ingestion_time"
BATCH_ID = "_batch_id"

_SIMPLE_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "float": T.FloatType(),
    "long": T.LongType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "integer": T.IntegerType(), "short": T.ShortType(), "smallint": T.ShortType(),
    "byte": T.ByteType(), "tinyint": T.ByteType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(), "binary": T.BinaryType(),
}
_NEW = "__sl_new_rescued"
_BOTH = "__sl_both_rescued"
_MAP_COL = "__sl_map"
_LEFT = "__sl_left"
_NAMES = "__sl_resolved"
_MAP = "map<string,string>"


def to_type(t) -> T.DataType:
    """A contract type name ('double', 'long', 'decimal(12,2)', ...) as a DataType."""
    if isinstance(t, T.DataType):
        return t
    key = t.strip().lower()
    if key in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[key]
    return T.DataType.fromDDL(t)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by exact name, dots and all."""
    return F.col(_q(name))


def rescued_map(rescued_col: str = RESCUED) -> Column:
    """The rescued JSON object parsed once as map<string,string>.
    Invalid JSON gives NULL; keys with dots are reachable; string values
    keep their text."""
    return F.from_json(col(rescued_col), T.MapType(T.StringType(), T.StringType()))


# ---------------------------------------------------------------------------
# W7 lineage
# ---------------------------------------------------------------------------

def lineage(df: DataFrame, file_col: str | None = "_metadata.file_path",
            now: Column | None = None) -> DataFrame:
    """Adds ``_source_file`` (from file metadata) and ``_ingestion_time``.

    Select ``_metadata`` on the scan (batch or stream plan), not inside a
    ``foreachBatch`` callback; pass ``file_col=None`` when the source file is
    already a column."""
    extra = []
    replaced = {INGESTION_TIME}
    if file_col is not None:            # the file's own path replaces any carried value
        extra.append(F.col(file_col).alias(SOURCE_FILE))
        replaced.add(SOURCE_FILE)
    extra.append((now if now is not None else F.current_timestamp()).alias(INGESTION_TIME))
    keep = [col(c) for c in df.columns if c not in replaced]
    return df.select(*keep, *extra)


# ---------------------------------------------------------------------------
# W4 capture: values that do not fit their column's type
# ---------------------------------------------------------------------------

def capture(df: DataFrame, target: Mapping[str, object],
            rescued_col: str = RESCUED) -> DataFrame:
    """Line ``df`` up with ``target`` (column -> type) in one ``select``.

    Columns named in ``target`` are cast with ``try_cast``; a non-NULL value
    that does not fit becomes NULL and its original text goes into the
    rescued JSON object under the column name. Of a nested value only the
    parts that do not fit become NULL, each with an entry under its address
    (``info.s``, ``tags[2]``, see ``fit``); fields new to the value are NULL
    where it has none. Columns not in ``target`` pass through unchanged; a column
    mapped to ``None`` is dropped and its text rescued. An incoming rescued
    object is kept, merged with the new captures (new text wins on a repeated
    name); incoming text that is not an object is kept under the rescued
    column's name. No value is lost.
    """
    schema = {f.name: f.dataType for f in df.schema.fields}
    names = list(schema)
    out, entries, nested = [], [], []
    for name, src_type in schema.items():
        if name == rescued_col:
            continue
        if name not in target:
            out.append(col(name))
            continue
        if target[name] is None:
            # a column the table does not take (evolution off): text only
            entries.append((name, text_of(col(name), src_type)))
            continue
        dst_type = to_type(target[name])
        if src_type == dst_type or relaxed(src_type) == relaxed(dst_type):
            out.append(col(name))
            continue
        if is_nested(src_type) and is_nested(dst_type):
            value, missed = conform(col(name), relaxed(src_type), relaxed(dst_type), F.lit(root(name, names)))
            out.append(value.alias(name))
            nested.append(missed)
            continue
        if isinstance(dst_type, T.StringType):
            out.append(text_of(col(name), src_type).alias(name))
            continue
        if not castable(src_type, dst_type):
            out.append(F.lit(None).cast(dst_type).alias(name))
            entries.append((name, text_of(col(name), src_type)))
            continue
        cast = col(name).try_cast(dst_type)
        miss = misfit(col(name), src_type, cast, dst_type)
        out.append(F.when(~miss, cast).alias(name))       # a misfit leaves the column NULL
        entries.append((name, F.when(miss, text_of(col(name), src_type))))
    had = rescued_col in schema
    if not entries and not nested:
        rescued = col(rescued_col) if had else F.lit(None).cast(T.StringType())
        return df.select(*out, rescued.alias(rescued_col))
    any_miss = reduce(lambda a, b: a | b, [t.isNotNull() for _, t in entries]) if entries else F.lit(False)
    if not had and not nested:
        # fast path: to_json of a struct leaves out NULL fields; clean rows
        # (no misfit) build nothing
        obj = F.struct(*[t.alias(n) for n, t in entries])
        json = F.when(any_miss, F.to_json(obj))
        return df.select(*out, json.cast(T.StringType()).alias(rescued_col))
    # Step 1 computes the new captures under a private name; step 2 merges
    # them into the incoming object. (A lambda must not see a same-named
    # alias of the select it sits in.)
    none = F.array().cast(ENTRIES)
    new = none if not entries else F.when(any_miss, F.filter(
        F.array(*[F.struct(F.lit(n).alias("key"), t.alias("value")) for n, t in entries]),
        lambda e: e["value"].isNotNull())).otherwise(none)
    new = F.concat(new, *nested) if nested else new
    raw = col(rescued_col) if had else F.lit(None).cast(T.StringType())
    staged = df.select(*out, raw.alias(rescued_col), new.cast(ENTRIES).alias(_NEW))
    raw = col(rescued_col)
    old = F.map_entries(rescued_map(rescued_col))
    # incoming text that is not a JSON object is kept whole under the rescued
    # column's own name (no captured column can have that name)
    kept_text = F.array(F.struct(F.lit(rescued_col).alias("key"), raw.alias("value")))
    both = F.concat(F.when(raw.isNull(), none).otherwise(F.coalesce(old, kept_text)), F.col(_NEW))
    # Entries, not maps, are joined: a name may come twice (in the incoming
    # text, or there and here), and then its last text wins.
    staged = staged.select(*[col(c) for c in staged.columns],
                           F.when(F.size(_NEW) > 0, both).cast(ENTRIES).alias(_BOTH))
    keys = F.transform(F.col(_BOTH), lambda e: e["key"])
    last = F.filter(F.col(_BOTH), lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    json = F.when(F.size(_NEW) == 0, raw).otherwise(F.to_json(F.map_from_entries(last)))
    return staged.select(*[col(c) for c in staged.columns if c not in (_NEW, _BOTH, rescued_col)],
                         json.cast(T.StringType()).alias(rescued_col))


# ---------------------------------------------------------------------------
# W8 / W11 recover, W12 clear, W9 cast, W10 filter
# ---------------------------------------------------------------------------

def recover(df: DataFrame, types: Mapping[str, object], residual: str = "none",
            rescued_col: str = RESCUED, guard: Column | None = None) -> DataFrame:
    """Put rescued values back.

    For each column in ``types``: the existing value wins, else the rescued
    text cast to the type (``try_cast``), else NULL. A column missing from
    ``df`` is created from the rescued text.

    ``residual`` decides what stays in the rescued column:
    ``"none"`` leaves it as it was (ingest), ``"keep"`` removes only the
    entries now held by their column (text casts, and the column was empty
    or already has that value; a different value is a conflict and stays),
    ``"clear"`` sets it to NULL. Text that is not a JSON object is kept
    except in ``"clear"``. ``guard`` limits all changes to rows where it
    is true.

    The JSON is parsed once per row (staged projections; Spark does not
    merge a stage whose costly result is used several times): into a struct
    of just the wanted names, or, in ``"keep"``, into a map of all entries.
    """
    if rescued_col not in df.columns or not types:
        return df
    if residual not in ("none", "keep", "clear"):
        raise ValueError(f"residual must be none, keep or clear, not {residual!r}")
    dtypes = {n: to_type(t) for n, t in types.items()}
    schema = {f.name: f.dataType for f in df.schema.fields}
    base = [c for c in df.columns]
    raw = col(rescued_col)
    whole = residual == "keep" or any(is_nested(t) for t in dtypes.values())
    if whole:
        # the whole object as a map: entries not recovered must be kept, and
        # those of nested values stand under addresses
        taken = rescued_map(rescued_col)
    else:
        # only the wanted names, as a struct: faster to parse than a map
        taken = F.from_json(raw, T.StructType([T.StructField(n, T.StringType()) for n in dtypes]))
    # stage 1: parse once (NULL outside the guard, so those rows stay as they are)
    s1 = df.select(*[col(c) for c in base],
                   (taken if guard is None else F.when(guard, taken)).alias(_MAP_COL))
    m = F.col(_MAP_COL)
    at = {n: F.lit(root(n, base)) if is_nested(dtypes[n]) else F.lit(n) for n in dtypes}

    def have(n: str) -> Column:
        return col(n) if schema[n] == dtypes[n] else col(n).try_cast(dtypes[n])

    def found(n: str) -> Column:
        return parsed(m.getItem(n) if whole else m.getField(n), dtypes[n])

    def recovered(n: str) -> Column:
        if is_nested(dtypes[n]):
            old = F.when(m.isNotNull(), restore(col(n), relaxed(schema[n]), relaxed(dtypes[n]), at[n], m))
            keep = col(n) if relaxed(schema[n]) == relaxed(dtypes[n]) else \
                conform(col(n), relaxed(schema[n]), relaxed(dtypes[n]), at[n])[0]
            return F.coalesce(old, keep)
        return F.coalesce(have(n), found(n))

    # stage 2: recovered columns
    out2 = []
    for name in base:
        out2.append(recovered(name).alias(name) if name in dtypes else col(name))
    out2 += [found(n).alias(n) for n in dtypes if n not in schema]
    if residual != "none":
        out2.append(m)
    s2 = s1.select(*out2)
    if residual == "keep":
        # stage 3: an entry is resolved when its text casts to the column's
        # type and equals the column's value after recovery (it was empty,
        # or already held that value); the rest stays rescued
        left = F.map_filter(m, lambda k, v: ~F.array_contains(F.col(_NAMES), k))
        s2 = (s2.select(*[col(c) for c in s2.columns], _resolved(dtypes, base, m).alias(_NAMES))
              .select(*[col(c) for c in s2.columns], left.alias(_LEFT)))
    cols = [c for c in s2.columns if c not in (_MAP_COL, _LEFT)]
    if residual == "none":
        return s2.select(*[col(c) for c in cols])
    if residual == "clear":
        new = F.lit(None) if guard is None else F.when(~guard | guard.isNull(), raw)
    else:
        m, left = F.col(_MAP_COL), F.col(_LEFT)
        new = (F.when(raw.isNull() | m.isNull(), raw)     # untouched, or not a JSON object
               .when(F.size(left) == 0, F.lit(None))
               .when(F.size(left) == F.size(m), raw)      # nothing recovered: text unchanged
               .otherwise(F.to_json(left)))
    return s2.select(*[new.cast(T.StringType()).alias(c) if c == rescued_col else col(c)
                       for c in cols])


def unrecovered_flag(df: DataFrame, types: Mapping[str, object], name: str,
                     rescued_col: str = RESCUED) -> DataFrame:
    """Adds boolean ``name``: the row carries rescued text that its columns do
    not hold (what a keep-mode repair would leave). Apply after recovery.
    Only rows with rescued text are parsed; other rows take a constant
    branch. Columns pass through unchanged, so the lambda below cannot bind
    to a same-named alias."""
    if rescued_col not in df.columns:
        return df.withColumn(name, F.lit(False))
    raw = col(rescued_col)
    if not types:
        return df.withColumn(name, raw.isNotNull())
    dtypes = {n: to_type(t) for n, t in types.items() if n in df.columns}
    staged = df.select(*[col(c) for c in df.columns],
                       F.when(raw.isNotNull(), rescued_map(rescued_col)).alias(_MAP_COL))
    m = F.col(_MAP_COL)

    staged = staged.select(*[col(c) for c in staged.columns], _resolved(dtypes, df.columns, m).alias(_NAMES))
    flag = F.when(raw.isNull(), F.lit(False)).when(m.isNull(), F.lit(True)) \
        .otherwise(F.exists(F.map_keys(m), lambda k: ~F.array_contains(F.col(_NAMES), k)))
    return staged.select(*[col(c) for c in df.columns], flag.alias(name))


def _resolved(dtypes: Mapping[str, T.DataType], columns: Iterable[str], m: Column) -> Column:
    """The names and addresses in the rescued map whose text states the value
    that their column now holds."""
    columns = list(columns)
    flat = F.array_compact(F.array(*[F.when(col(n) == m.getItem(n).try_cast(t), F.lit(n))
                                     for n, t in dtypes.items() if not is_nested(t)])).cast("array<string>")
    nested = [held(col(n), t, F.lit(root(n, columns)), m) for n, t in dtypes.items() if is_nested(t)]
    # a nested value rescued whole stands under the plain name
    nested += [F.when(F.to_json(col(n)) == F.to_json(parsed(m.getItem(n), t)), F.array(F.lit(n)))
               .otherwise(F.array().cast("array<string>")) for n, t in dtypes.items() if is_nested(t)]
    return F.concat(flat, *nested) if nested else flat


def clear_rescued(df: DataFrame, rescued_col: str = RESCUED) -> DataFrame:
    """W12 in the source system's form: the rescued value becomes a string NULL."""
    return df.withColumn(rescued_col, F.lit(None).cast(T.StringType()))


def cast_to_contract(df: DataFrame, types: Mapping[str, object]) -> DataFrame:
    """Every declared column present in ``df`` cast to its type, in one
    ``select``; absent columns are skipped. ``try_cast``: a value that does
    not fit becomes NULL instead of failing the batch (use ``capture``
    first to keep its text)."""
    out = []
    for f in df.schema.fields:
        if f.name in types and to_type(types[f.name]) != f.dataType:
            out.append(col(f.name).try_cast(to_type(types[f.name])).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


def rescued_filter(df: DataFrame, rescued_col: str = RESCUED) -> DataFrame:
    """Rows that still carry rescued values (pushed to the Parquet scan)."""
    return df.filter(col(rescued_col).isNotNull())


def merge_projection(df: DataFrame, key: str, columns: Iterable[str],
                     rescued_col: str = RESCUED) -> DataFrame:
    """Key + recovered columns + rescued column."""
    cols = [key] + [c for c in columns if c != key] + [rescued_col]
    return df.select(*[col(c) for c in cols])
