"""Keyed tables (registries) changed by batches, not by single-row calls.

A registry is a DataFrame with ``id`` and ``created_at``/``updated_at``; each
operation returns the new table (write it back with ``io.write``-style sinks
or ``saveAsTable``). New ids are contiguous and follow a given order without
a single-partition window: the batch is range-partitioned by the order
columns, and each partition's offset comes from a per-partition count (a
table with one row per partition)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekpanel.schema import REGISTRY_KEYS
from weekpanel.session import cut_lineage

_LOW = (1 << 33) - 1


def declared_columns(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep only declared, caller-settable columns (never id or stamps); cast
    to the declared types; unknown columns are dropped."""
    keep = [f for f in schema.fields if f.name not in REGISTRY_KEYS and f.name in batch.columns]
    return batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in keep])


def dense_index(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """Adds ``_idx`` = 1..n following ``order`` (ties broken by every column).

    The range-sorted rows are written once with their partition number and place. Counts and rows
    are both read from that one table, so they agree whatever the planner does
    with partitions in between."""
    orderable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))]
    mid = F.monotonically_increasing_id()
    t = df.orderBy(*order, *[F.col(f"`{c}`") for c in orderable]).withColumn("_mid", mid)
    t = cut_lineage(t, "ordered")
    t = t.withColumn("_part", F.shiftright("_mid", 33)).withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW)))
    counts = t.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: a global window over it is tiny
    offs = counts.select("_part", F.coalesce(
        F.sum("_cnt").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return t.join(F.broadcast(offs), "_part").withColumn("_idx", F.col("_off") + F.col("_pos") + 1).drop(
        "_mid", "_part", "_pos", "_off"
    )


def append(table: DataFrame, batch: DataFrame, schema: T.StructType, stamp, order: list[str] | None = None) -> DataFrame:
    """Insert a batch: declared columns only, new ids after the current max id
    in ``order``, created_at = updated_at = ``stamp``. An empty batch leaves
    the table unchanged."""
    clean = declared_columns(batch, schema)
    max_id = table.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_max"))
    idx = dense_index(batch, order or [])
    ts = F.lit(stamp).cast("timestamp")
    new = idx.crossJoin(F.broadcast(max_id)).select(
        (F.col("_max") + F.col("_idx")).cast("long").alias("id"), *clean.columns,
        ts.alias("created_at"), ts.alias("updated_at"),
    )
    full = [f.name for f in schema.fields]
    new = new.select(*[F.col(c) if c in new.columns else F.lit(None).cast(schema[c].dataType).alias(c) for c in full])
    return table.select(*full).unionByName(new)


def list_all(table: DataFrame) -> DataFrame:
    """Newest first: created_at desc, id desc."""
    return table.orderBy(F.col("created_at").desc(), F.col("id").desc())


def update(table: DataFrame, changes: DataFrame, schema: T.StructType, stamp) -> DataFrame:
    """Overlay the given fields of each (id, fields...) change row and bump
    updated_at; other rows untouched; unknown ids change nothing.

    A change row gives the fields that are not null; to give a null, list the
    fields given in an array column ``given`` (it then decides alone). Several change rows
    of one id must agree on no field twice: their given fields are merged, and
    a field given twice keeps the largest value, so the result has one row per id."""
    fields = declared_columns(changes, schema).columns
    is_given = (lambda c: F.array_contains("given", c)) if "given" in changes.columns else (lambda c: F.col(f"`{c}`").isNotNull())
    one = changes.where("id is not null").groupBy(F.col("id").alias("_cid")).agg(
        F.lit(True).alias("_hit"),
        *[F.max(F.when(is_given(c), F.col(f"`{c}`").cast(schema[c].dataType))).alias(f"_new_{c}") for c in fields if not isinstance(schema[c].dataType, T.MapType)],
        *[F.max_by(F.col(f"`{c}`").cast(schema[c].dataType), F.when(is_given(c), F.lit(1))).alias(f"_new_{c}") for c in fields if isinstance(schema[c].dataType, T.MapType)],
        *[F.coalesce(F.bool_or(is_given(c)), F.lit(False)).alias(f"_given_{c}") for c in fields])
    j = table.join(one, table.id == F.col("_cid"), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    cols = []
    for f in schema.fields:
        c = f.name
        if c in fields:
            cols.append(F.when(F.coalesce(F.col(f"_given_{c}"), F.lit(False)), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        elif c == "updated_at":
            cols.append(F.when(hit, F.lit(stamp).cast("timestamp")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def delete(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Remove the rows whose id is in ``ids`` (left anti join)."""
    return table.join(ids.select(F.col("id").alias("_did")).distinct(), table.id == F.col("_did"), "left_anti")


def delete_all(table: DataFrame) -> DataFrame:
    return table.limit(0)


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def parse_json_map(text: Column, value_type: str = "double") -> Column:
    """JSON object text -> map; unparsable text -> NULL (see ``json_roundtrip``)."""
    return F.from_json(text, f"map<string,{value_type}>", {"mode": "PERMISSIVE"})


def json_roundtrip(df: DataFrame, col: str) -> DataFrame:
    """Parse a JSON text column into a map and serialise it back.

    An object of numbers becomes a map of doubles and their text; any other object keeps its values as they
    stand (text, nested and mixed values included) in ``<col>_any``, a map of
    strings; text that is no object is kept as it was."""
    numbers = parse_json_map(F.col(col))
    anything = parse_json_map(F.col(col), "string")
    return df.withColumn(f"{col}_map", numbers).withColumn(f"{col}_any", anything).withColumn(
        f"{col}_text", F.when(numbers.isNotNull(), F.to_json(numbers)).otherwise(F.col(col)))


def registry_kpis(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("cases"), F.lit(0)).cast("long").alias("total_cases"),
        F.countDistinct("district").alias("districts"), F.countDistinct("year").alias("years"),
    )
