"""The master panel plan: raw cases -> clean -> calendar -> unit-week
aggregate -> zero-filled gaps -> minimum history -> features -> split and
label. One lazy plan; the raw scan is read once (the shared aggregate's
exchange is reused by every branch)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.operators.clean import clean_cases
from weekpanel.operators.features import add_features
from weekpanel.operators.label import add_target_and_split
from weekpanel.operators.panel import (
    attach_geography,
    case_columns,
    case_groups,
    epi_calendar,
    fill_zero_weeks,
    fold_group_severity,
    min_history,
    modal_geography,
    panel_rows,
    panel_years,
    unit_spans,
    unit_week_aggregate,
)
from weekpanel.params import DEFAULT, Params
from weekpanel.schema import MASTER_COLUMNS, ORIGIN_REAL
from weekpanel.session import cut_lineage


# rows of the panel that one task holds: a sort or window over all its columns stays within some 100 MB
ROWS_PER_TASK = 250_000


def dense_panel(raw: DataFrame, params: Params = DEFAULT, materialize: bool = True, columns: list[str] | None = None):
    """Zero-filled unit x week panel with modal geography (before features),
    plus the calendar and the unit spans it came from.

    The raw scan feeds four branches (calendar, aggregate, gaps, geography);
    with ``materialize`` its one aggregate is checkpointed to the shared
    checkpoint folder, so the raw data is read exactly once and a lost
    executor never forces a re-read of it. The small calendar and unit spans
    are written too: they give the panel's size, by which the units are dealt
    to tasks of bounded size. (Shuffled unit-weeks shrink to a few bytes a row, so
    partitions of a given number of bytes would hold millions of wide panel rows.)
    With ``columns`` cases are grouped by, and summed over, only what these panel
    columns come from."""
    cases = clean_cases(raw, params, fold_text=False)
    if columns is not None:
        cases = cases.select(*case_columns(columns))
    groups = case_groups(cases)
    if materialize:
        groups = cut_lineage(groups, "case_groups")
    geo = modal_geography(groups, fold=True)
    if "disease" in groups.columns:
        groups = fold_group_severity(groups)
    cal = epi_calendar(groups.select("year", "week"))
    if materialize:
        cal = cut_lineage(cal, "calendar")
    agg = unit_week_aggregate(groups, cal)
    if not materialize:
        return attach_geography(fill_zero_weeks(agg, cal), geo), cal, unit_spans(agg)
    weeks = groups.join(F.broadcast(cal.select("year", "week", "week_id")), ["year", "week"])
    spans = cut_lineage(unit_spans(weeks), "unit_spans")
    parts = max(raw.sparkSession.sparkContext.defaultParallelism, -(-panel_rows(spans) // ROWS_PER_TASK))
    filled = fill_zero_weeks(agg.repartition(parts, "unit_id"), cal)
    return attach_geography(filled, geo.repartition(parts, "unit_id")), cal, spans


def build_master(raw: DataFrame, params: Params = DEFAULT, materialize: bool = True, columns: list[str] | None = None) -> DataFrame:
    """The 26-column master panel, or its ``columns``.

    Shuffles: the raw cases once (partial aggregate by unit-week-spelling),
    the observed unit-weeks once by unit; the gap fill, history filter,
    features, threshold and label are windows on that same partitioning. The
    split years come from small tables (unit spans x per-year ranges)."""
    panel, cal, spans = dense_panel(raw, params, materialize, columns)
    panel = min_history(panel, params.min_history_weeks)
    years = panel_years(spans, cal, params.min_history_weeks)
    feats = add_features(panel, params.ma_window, params.season_length)
    feats = feats.withColumn("origin", F.lit(ORIGIN_REAL))
    return add_target_and_split(feats, params, years).select(*(MASTER_COLUMNS if columns is None else columns))


def load_or_build_master(spark, path: str, raw: DataFrame | None = None, rebuild: bool = False,
                         extend: bool = True, real_only: bool = False, params: Params = DEFAULT) -> DataFrame:
    """Reuse the saved panel at ``path`` unless ``rebuild``; otherwise build
    it from ``raw`` (optionally extended by seasonal bootstrap), write it
    partitioned by split, and continue from the written table."""
    from weekpanel.operators.extend import extend_panel
    from weekpanel.sources import io

    m = None if rebuild else io.read_optional(spark, path)
    if m is None:
        if raw is None:
            raise ValueError("no saved panel and no raw case list to build one from")
        m = build_master(raw, params)
        if extend:
            m = extend_panel(m, params)
        io.write_master(m, path)
    m = io.read_master(spark, path)
    return m.filter(F.col("origin") == ORIGIN_REAL) if real_only else m
