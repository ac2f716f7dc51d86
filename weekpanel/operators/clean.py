"""Row-level cleaning of a raw case list (all text) into typed cases.

Duplicate rows are kept on purpose: every row is one notified case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.functions.scalar import age_in_years, lenient_int
from weekpanel.functions.text import normalize_header, normalize_text, strip_ws
from weekpanel.params import DEFAULT, Params
from weekpanel.schema import GEO_COLS

# fixed values: disease labels (after text folding) that mark warning signs
# or a severe case
WARNING_LABELS = ["DENGUE CON SIGNOS DE ALARMA", "DENGUE GRAVE"]
SEVERE_LABEL = "DENGUE GRAVE"
MISSING_KEY = "nan"


def severity_flags(disease_folded):
    return (
        F.coalesce(disease_folded.isin(*WARNING_LABELS), F.lit(False)).cast("int"),
        F.coalesce(disease_folded == F.lit(SEVERE_LABEL), F.lit(False)).cast("int"),
    )


def clean_cases(raw: DataFrame, params: Params = DEFAULT, fold_text: bool = True) -> DataFrame:
    """Typed cases: folded geography and disease, lenient year/week, age in
    years, 0/1 severity and sex flags, rows outside the valid year/week range
    dropped (a missing year or week fails the range).

    With ``fold_text=False`` geography and disease stay as raw text and the
    flags are left to the caller: the panel plan folds text on its aggregated
    spellings instead of on every row (same result, far fewer rows)."""
    df = normalize_header(raw)
    sex = F.upper(strip_ws(F.col("sex")))
    if fold_text:
        warn, severe = severity_flags(normalize_text("disease"))
        text = [*[normalize_text(c).alias(c) for c in GEO_COLS], warn.alias("warn_or_severe"), severe.alias("severe")]
    else:
        text = [*[F.col(c) for c in GEO_COLS], F.col("disease")]
    out = df.select(
        F.coalesce(strip_ws(F.col("unit_id")), F.lit(MISSING_KEY)).alias("unit_id"),
        lenient_int("year").alias("year"),
        lenient_int("week").alias("week"),
        age_in_years("age", "age_unit", params.age_max).alias("age_years"),
        F.coalesce(sex == F.lit("F"), F.lit(False)).cast("int").alias("female"),
        *text,
    )
    return out.filter(
        F.col("week").between(params.week_min, params.week_max)
        & F.col("year").between(params.year_min, params.year_max)
    )
