"""What the rescued entries of tables are worth.

One pass over a table's rescued rows gives, for each column named in them, how
many entries

* ``held``          state the value that their column already holds,
* ``recoverable``   would fill their column (or the part of it at their address),
* ``conflicting``   cast to the column's type, but the column holds another value,
* ``stuck``         do not cast to the column's type,
* ``unknown``       name no column of the table.

A worklist made from it names only columns that a repair can change.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import TableContract
from strandline.functions.columns import (BATCH_ID, INGESTION_TIME, RESCUED, SOURCE_FILE, col, rescued_filter,
                                          rescued_map, to_type)
from strandline.functions.fit import held, parsed, restore, root
from strandline.functions.lattice import is_nested, relaxed

STATES = ("held", "recoverable", "conflicting", "stuck", "unknown")
CENSUS = "table_name string, column string, rescued long, " + ", ".join(f"{s} long" for s in STATES)
_M, _KEYS = "__sl_map", "__sl_keys"


def _flat(name: str, t, m: Column) -> Column:
    """The state of a flat column's entry, NULL without one."""
    text, value, cast = m[name], col(name), m[name].try_cast(t)
    return (F.when(text.isNull(), F.lit(None)).when(cast.isNull(), "stuck").when(value.isNull(), "recoverable")
            .when(value == cast, "held").otherwise("conflicting"))


def table_census(df: DataFrame, name: str, types: Mapping[str, object], rescued_col: str = RESCUED) -> DataFrame:
    """(table_name, column, rescued, one count for each state) of one table.
    ``types``: the contract's; other columns have their stored types. Only rows
    with rescued text are read (pushed to the scan), and counted before
    they are shuffled. Text that is no JSON object counts as ``unknown`` under
    the rescued column's name."""
    if rescued_col not in df.columns:
        return df.sparkSession.createDataFrame([], CENSUS)
    own = {f.name: to_type(types[f.name]) if f.name in types else f.dataType for f in df.schema.fields
           if f.name not in (rescued_col, BATCH_ID, SOURCE_FILE, INGESTION_TIME)}
    rows = rescued_filter(df, rescued_col)
    m = F.col(_M)
    staged = rows.select(*[col(c) for c in own], rescued_map(rescued_col).alias(_M))
    states = []
    for n, t in own.items():
        if not is_nested(t):
            states.append(F.array_compact(F.array(F.when(m[n].isNotNull(), F.struct(
                F.lit(n).alias("column"), _flat(n, t, m).alias("state"))))))
            continue
        at, stored = F.lit(root(n, own)), relaxed(df.schema[n].dataType)
        head = root(n, own)
        mine = F.filter(F.map_keys(m), lambda k: (k == n) | k.startswith(head + ".") | k.startswith(head + "["))
        before = held(col(n), stored, at, m)
        after = held(restore(col(n), stored, relaxed(t), at, m), relaxed(t), at, m)
        whole = F.when(col(n).isNull() & parsed(m[n], relaxed(t)).isNotNull(), "recoverable")
        states.append(F.transform(mine, lambda k: F.struct(
            F.lit(n).alias("column"),
            F.when(F.array_contains(before, k), "held").when(F.array_contains(after, k), "recoverable")
            .otherwise(F.coalesce(F.when(k == n, whole), F.lit("stuck"))).alias("state"))))
    heads = [root(n, own) for n, t in own.items() if is_nested(t)]

    def known(k: Column) -> Column:
        out = k.isin(list(own))
        for h in heads:
            out = out | k.startswith(h + ".") | k.startswith(h + "[")
        return out
    rest = F.transform(F.filter(F.map_keys(m), lambda k: ~known(k)), lambda k: F.struct(
        k.alias("column"), F.lit("unknown").alias("state")))
    no_object = F.array(F.struct(F.lit(rescued_col).alias("column"), F.lit("unknown").alias("state")))
    entries = F.when(m.isNull(), no_object).otherwise(F.concat(*states, rest) if states else rest)
    e = staged.select(F.explode(entries).alias("e")).select("e.column", "e.state")
    return (e.groupBy("column").agg(F.count(F.lit(1)).alias("rescued"),
                                    *[F.count_if(F.col("state") == s).alias(s) for s in STATES])
            .select(F.lit(name).alias("table_name"), "column", "rescued", *STATES))


def rescue_census(spark: SparkSession, tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract],
                  rescued_col: str = RESCUED) -> DataFrame:
    """``table_census`` of each table, one job for all."""
    parts = [table_census(df, n, contracts[n].types if n in contracts else {}, rescued_col) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], CENSUS)


def census_worklist(census: DataFrame, contracts: Mapping[str, TableContract],
                    states: Sequence[str] = ("recoverable", "held")) -> DataFrame:
    """Worklist items (table_name, primary_key, rescued_cols, rows_rescued)
    that name only the columns in which a repair changes something: those with entries
    in ``states``. ``rows_rescued`` counts these entries. A table without any
    is left out."""
    spark = census.sparkSession
    items = spark.createDataFrame([(n, c.key) for n, c in contracts.items()], "table_name string, primary_key string")
    worth = sum((F.col(s) for s in states), F.lit(0).cast("long"))
    return (census.withColumn("worth", worth).filter("worth > 0")
            .groupBy("table_name").agg(
                F.array_join(F.sort_array(F.collect_list("column")), ",").alias("rescued_cols"),    # a table's columns
                F.sum("worth").alias("rows_rescued"))
            .join(F.broadcast(items), "table_name")
            .select("table_name", "primary_key", "rescued_cols", "rows_rescued"))
