"""Table schemas and column-name constants."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw case list: one row per notified event, every column text on read.
RAW_COLUMNS = [
    "region", "province", "district", "disease", "year", "week", "unit_id",
    "age", "age_unit", "sex", "locality", "diagnostic", "health_office", "locality_code",
]
RAW_CASES = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

GEO_COLS = ["region", "province", "district"]
AUX_COLS = ["age_mean", "warn_share", "severe_share", "female_share"]

BASE_COLUMNS = [
    "unit_id", "region", "province", "district", "year", "week", "week_start", "week_id",
    "cases", *AUX_COLS,
]
FEATURE_NUMERIC = [
    "cases", "cases_lag_1", "cases_lag_2", "cases_lag_4", "roll_mean_4", "roll_mean_8",
    "roll_std_4", "growth", "week_sin", "week_cos",
]
FEATURE_CATEGORICAL = ["region"]
TARGET = "target"
KEY = ["unit_id", "week_start"]

MASTER_COLUMNS = (
    BASE_COLUMNS
    + [c for c in FEATURE_NUMERIC if c != "cases"]
    + ["threshold", "split", TARGET, "origin"]
)

MASTER = T.StructType([
    T.StructField("unit_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("week_start", T.DateType()),
    T.StructField("week_id", T.LongType()),
    T.StructField("cases", T.LongType()),
    *[T.StructField(c, T.DoubleType()) for c in AUX_COLS],
    *[T.StructField(c, T.DoubleType()) for c in FEATURE_NUMERIC if c != "cases"],
    T.StructField("threshold", T.DoubleType()),
    T.StructField("split", T.StringType()),
    T.StructField(TARGET, T.IntegerType()),
    T.StructField("origin", T.StringType()),
])

# Keyed registries (batch change tables)
CASE_REGISTRY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("unit_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("cases", T.LongType()),
    T.StructField("note", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])
QUERY_REGISTRY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("region", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("model", T.StringType()),
    T.StructField("inputs", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("probability", T.DoubleType()),
    T.StructField("prediction", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])
REGISTRY_KEYS = {"id", "created_at", "updated_at"}

# fixed values: origin and split tags
ORIGIN_REAL = "real"
ORIGIN_SIMULATED = "simulated"
SPLITS = ("train", "val", "test")
