"""Dense unit x week panel: calendar, unit-week aggregate, modal geography,
zero-filled gaps, minimum-history filter.

Scale notes
-----------
* The raw cases are read once: one partial aggregate groups them by
  (unit, year, week, geography). Everything after that works on aggregated
  rows (at most one row per unit-week and spelling), so a unit holding a third
  of all cases costs one map-side-combined group, not a third of the data in
  one task.
* The calendar has at most 53 rows per year in a bounded year range
  (params.year_min..year_max), so broadcasting it is safe.
* Gaps are filled without a join: a window by unit finds the next observed
  week, and ``explode(sequence)`` emits the missing weeks in place, keeping
  the hash partitioning by unit for every later window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.functions.calendar import epi_week_start
from weekpanel.functions.text import normalize_text
from weekpanel.schema import AUX_COLS, GEO_COLS

def unit_order(unit: str = "unit_id", order: str = "week_id"):
    """The one window spec every per-unit ordered operator shares."""
    return Window.partitionBy(unit).orderBy(order)


def case_groups(cases: DataFrame) -> DataFrame:
    """One map-side-combined aggregate of the cleaned cases by unit, week and
    text spelling (geography, and the raw disease label when the cases were
    cleaned without folding); re-aggregable sums only. Columns that ``cases`` lacks
    are neither grouped by nor summed."""
    keys = [c for c in ["unit_id", "year", "week", *GEO_COLS, "disease"] if c in cases.columns]
    sums = {
        "age_sum": ("age_years", F.sum), "age_n": ("age_years", F.count), "warn_n": ("warn_or_severe", F.sum),
        "severe_n": ("severe", F.sum), "female_n": ("female", F.sum),
    }
    return cases.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[fn(c).alias(out) for out, (c, fn) in sums.items() if c in cases.columns]
    )


def case_columns(columns: list[str]) -> list[str]:
    """The columns of cleaned, unfolded cases that the panel's ``columns`` come from."""
    needs = {"age_mean": "age_years", "warn_share": "disease", "severe_share": "disease", "female_share": "female"}
    return ["unit_id", "year", "week", *[c for c in GEO_COLS if c in columns], *dict.fromkeys(needs[c] for c in AUX_COLS if c in columns)]


def fold_group_severity(groups: DataFrame) -> DataFrame:
    """Warning / severe counts from raw disease spellings, folded in place on
    the aggregated rows (a join on the few spellings would be a join on hot keys)."""
    from weekpanel.operators.clean import severity_flags

    warn, severe = severity_flags(normalize_text("disease"))
    return groups.withColumns({"warn_n": F.col("n") * warn, "severe_n": F.col("n") * severe}).drop("disease")


def epi_calendar(weeks: DataFrame) -> DataFrame:
    """Global week grid: for each year present, weeks 1..max observed week of
    that year, numbered 0.. in order (years without rows are skipped, so the
    numbering stays contiguous)."""
    wmax = weeks.groupBy("year").agg(F.max("week").alias("wmax"))
    cal = wmax.select("year", F.explode(F.sequence(F.lit(1), F.col("wmax"))).alias("week"))
    # tiny table (<= 53 rows per year): a single-partition numbering is fine
    cal = cal.withColumn(
        "week_id", (F.row_number().over(Window.orderBy("year", "week")) - 1).cast("long")
    )
    return cal.withColumn("week_start", epi_week_start("year", "week"))


def modal_geography(groups: DataFrame, fold: bool = False) -> DataFrame:
    """Most frequent (folded) spelling of each geography column per unit; ties
    go to the smallest value; NULLs are ignored (all-NULL -> NULL). With
    ``fold`` the raw spellings are counted first and folded afterwards, so
    the text work runs on (unit, spelling) pairs only. Groups are summed up by
    unit and geography before the columns are stacked, so the rows that are
    stacked are as many as spellings, not as unit-weeks. Geography columns that
    ``groups`` lacks are left out."""
    geo = [c for c in GEO_COLS if c in groups.columns]
    places = groups.groupBy("unit_id", *geo).agg(F.sum("n").alias("n"))
    if not geo:
        return places.select("unit_id")
    kv = places.select(
        "unit_id",
        "n",
        F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("v")) for c in geo])).alias("kv"),
    ).select("unit_id", "n", "kv.k", "kv.v").filter(F.col("v").isNotNull())
    counts = kv.groupBy("unit_id", "k", "v").agg(F.sum("n").alias("cnt"))
    if fold:
        counts = counts.withColumn("v", normalize_text("v")).groupBy("unit_id", "k", "v").agg(F.sum("cnt").alias("cnt"))
    return counts.groupBy("unit_id").agg(
        *[
            F.min_by(
                F.when(F.col("k") == c, F.col("v")),
                F.when(F.col("k") == c, F.struct((-F.col("cnt")).alias("neg"), F.col("v").alias("v"))),
            ).alias(c)
            for c in geo
        ]
    )


def unit_week_aggregate(groups: DataFrame, calendar: DataFrame) -> DataFrame:
    """Observed unit-weeks: row count (every case, whatever its fields), mean
    age over known ages, shares of the three flags; calendar ids attached.
    Means and shares whose sums ``groups`` lacks are left out."""
    sums = [c for c in ("age_sum", "age_n", "warn_n", "severe_n", "female_n") if c in groups.columns]
    agg = groups.groupBy("unit_id", "year", "week").agg(F.sum("n").alias("cases"), *[F.sum(c).alias(c) for c in sums])
    shares = [(F.col(c) / F.col("cases")).alias(c.replace("_n", "_share")) for c in ("warn_n", "severe_n", "female_n") if c in sums]
    ages = [F.when(F.col("age_n") > 0, F.col("age_sum") / F.col("age_n")).alias("age_mean")] if "age_n" in sums else []
    agg = agg.select("unit_id", "year", "week", F.col("cases").cast("long").alias("cases"), *ages, *shares)
    return agg.join(F.broadcast(calendar.select("year", "week", "week_id", "week_start")), ["year", "week"], "left")


def fill_zero_weeks(agg: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every calendar week between a unit's first and last observed week; the
    missing ones get 0 cases and NULL means. Never extends past the last
    observation."""
    nxt = F.lead("week_id").over(unit_order())
    g = agg.withColumn("_next", nxt)
    g = g.withColumn(
        "_wid", F.explode(F.sequence(F.col("week_id"), F.coalesce(F.col("_next") - 1, F.col("week_id"))))
    )
    observed = F.col("_wid") == F.col("week_id")
    filled = g.select(
        "unit_id",
        F.col("_wid").alias("week_id"),
        F.when(observed, F.col("cases")).otherwise(F.lit(0).cast("long")).alias("cases"),
        *[F.when(observed, F.col(c)).alias(c) for c in AUX_COLS if c in agg.columns],
    )
    cal = F.broadcast(calendar.select("week_id", "year", "week", "week_start"))
    return filled.join(cal, "week_id", "left")


def attach_geography(panel: DataFrame, geo: DataFrame) -> DataFrame:
    return panel.join(geo, "unit_id", "left")


def min_history(panel: DataFrame, min_weeks: int) -> DataFrame:
    """Keep units with at least ``min_weeks`` panel rows (counted in the order of
    the later windows, so that the panel is sorted once for all of them)."""
    n = F.count(F.lit(1)).over(unit_order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return panel.withColumn("_n", n).filter(F.col("_n") >= min_weeks).drop("_n")


def unit_spans(agg: DataFrame) -> DataFrame:
    """First and last observed week id per unit (the zero-filled panel has
    exactly hi - lo + 1 rows for the unit)."""
    return agg.groupBy("unit_id").agg(F.min("week_id").alias("lo"), F.max("week_id").alias("hi"))


def panel_rows(spans: DataFrame) -> int:
    """Rows of the zero-filled panel (before the history filter)."""
    return spans.agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0] or 0


def panel_years(spans: DataFrame, calendar: DataFrame, min_weeks: int) -> DataFrame:
    """Distinct years of the zero-filled, history-filtered panel, derived from
    unit spans and the per-year week-id ranges (<= 53 * years rows) instead of
    a pass over the panel itself."""
    spans = spans.filter(F.col("hi") - F.col("lo") + 1 >= min_weeks)
    yr = calendar.groupBy("year").agg(F.min("week_id").alias("ylo"), F.max("week_id").alias("yhi"))
    hit = spans.join(F.broadcast(yr), (F.col("ylo") <= F.col("hi")) & (F.col("yhi") >= F.col("lo")))
    return hit.select("year").distinct()
