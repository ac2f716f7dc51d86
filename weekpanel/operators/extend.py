"""Panel extension by seasonal bootstrap, as batch resampling of a table.

For every active unit and every week of a target calendar (from the last real
week to a horizon), one past week of the same unit is drawn from a circular
band of +-band weeks around the target week, within the last ``lookback``
years, weighted by recency; the draw is scaled by a yearly intensity,
smoothed with a centred window, multiplied by exp of an AR(1) path and
rounded half-even.

Scale notes
-----------
* The band join is an equi-join on (unit, (week - 1) mod 52): each target
  week is exploded into its 2*band+1 neighbour residues. Week 53 has the same
  distances as week 1, so this equals the circular band exactly. Candidates
  per target week are bounded by lookback years x band width.
* Draws use exponential keys (min of -ln(u)/w) with u from md5 of the row
  identity: reproducible for any partitioning, no driver-side RNG.
* The AR(1) path is a sequential recursion per unit over the target calendar
  (its length is the horizon, a parameter), computed with ``aggregate`` on the
  unit's sorted target weeks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekpanel.functions.calendar import epi_week_start, roll_week
from weekpanel.functions.scalar import hash_uniform
from weekpanel.operators.features import add_features
from weekpanel.operators.label import add_target_and_split
from weekpanel.operators.panel import unit_order
from weekpanel.params import DEFAULT, Params
from weekpanel.schema import AUX_COLS, BASE_COLUMNS, GEO_COLS, MASTER_COLUMNS, ORIGIN_REAL, ORIGIN_SIMULATED
from weekpanel.session import cut_lineage

PERIOD = 52


def _last(real: DataFrame) -> DataFrame:
    """One row: last real (year, week), last week id, last year."""
    return real.agg(
        F.max(F.struct("year", "week")).alias("yw"), F.max("week_id").alias("wid0"), F.max("year").alias("last_year")
    ).select(F.col("yw.year").alias("y0"), F.col("yw.week").alias("w0"), "wid0", "last_year")


def target_calendar(real: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(year, week, week_id, week_start) after the last real week up to the
    horizon, wrapping after week 52; week ids continue the real numbering."""
    last = _last(real)
    steps = (F.lit(params.extend_to_year) - F.col("y0")) * PERIOD + (
        F.lit(params.extend_to_week) - F.least(F.col("w0"), F.lit(PERIOD))
    )
    s = last.select("*", F.explode(F.when(steps >= 1, F.sequence(F.lit(1), steps.cast("int"))).otherwise(
        F.array().cast("array<int>"))).alias("i"))
    y, w = roll_week(F.col("y0"), F.col("w0"), F.col("i"), PERIOD)
    return s.select(
        y.alias("year"), w.alias("week"), (F.col("wid0") + F.col("i")).cast("long").alias("week_id"),
    ).withColumn("week_start", epi_week_start("year", "week"))


def active_units(real: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Units with rows in the last ``active_years`` real years."""
    last = F.broadcast(_last(real).select("last_year"))
    j = real.select("unit_id", "year").crossJoin(last)
    return j.filter(F.col("year") >= F.col("last_year") - params.active_years + 1).select("unit_id").distinct()


def pool(real: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Past weeks each unit may draw from: its rows of the last ``lookback``
    years (all its rows if it has none there), with residue and weight."""
    last = F.broadcast(_last(real).select("last_year"))
    j = real.crossJoin(last)
    inside = F.col("year") >= F.col("last_year") - params.lookback_years + 1
    any_inside = F.max(inside.cast("int")).over(Window.partitionBy("unit_id"))
    p = j.withColumn("_in", inside).withColumn("_any", any_inside).filter(F.col("_in") | (F.col("_any") == 0))
    return p.select(
        "unit_id", F.col("year").alias("p_year"), F.col("week").alias("p_week"), F.col("week_id").alias("p_week_id"),
        F.col("cases").alias("p_cases"), *[F.col(c).alias(f"p_{c}") for c in AUX_COLS],
        F.pmod(F.col("week") - 1, F.lit(PERIOD)).alias("residue"),
        F.pow(F.lit(params.recency_decay), (F.col("last_year") - F.col("year")).cast("double")).alias("weight"),
    )


def targets(real: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Active units x target calendar (the rows to generate)."""
    cal = F.broadcast(target_calendar(real, params))  # bounded by the horizon
    return active_units(real, params).crossJoin(cal)


def candidates(tg: DataFrame, pl: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Target week <-> pool rows within the circular band (equi-join on
    residues); targets with no match in the band get the unit's whole pool."""
    offs = F.array(*[F.lit(d) for d in range(-params.band_weeks, params.band_weeks + 1)])
    ex = tg.select("unit_id", "year", "week", "week_id", F.explode(offs).alias("d")).select(
        "unit_id", "year", "week", "week_id", F.pmod(F.col("week") - 1 + F.col("d"), F.lit(PERIOD)).alias("residue")
    ).distinct()
    band = ex.join(pl, ["unit_id", "residue"]).drop("residue")
    hit = band.select("unit_id", "week_id").distinct()
    miss = tg.join(hit, ["unit_id", "week_id"], "left_anti")
    fallback = miss.select("unit_id", "year", "week", "week_id").join(pl.drop("residue"), "unit_id")
    return band.unionByName(fallback)


def weighted_draw(cand: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """One pool row per (unit, target week), drawn with probability
    proportional to its weight (exponential keys), from a long candidate
    table. See ``draw`` for the array form used by ``simulate``."""
    u = hash_uniform("unit_id", "week_id", "p_week_id", seed=params.seed)
    key = -F.log(u) / F.col("weight")
    drawn = F.struct("p_week_id", "p_cases", *[f"p_{c}" for c in AUX_COLS])
    return cand.groupBy("unit_id", "year", "week", "week_id").agg(
        F.min_by(drawn, F.struct(key.alias("k"), F.col("p_week_id").alias("p"))).alias("d")
    ).select("unit_id", "year", "week", "week_id", "d.*")


_CAND_FIELDS = ["p_week_id", "weight", "p_cases", *[f"p_{c}" for c in AUX_COLS]]


def candidate_arrays(pl: DataFrame, params: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Candidates per (unit, target week of year) as arrays: the pool rows
    whose residue is within the circular band of that week (at most
    lookback years x (2 band + 1) rows), and per unit the whole pool (the
    fallback when the band is empty). The target weeks and offsets are a
    52 x (2 band + 1) parameter table."""
    spark = pl.sparkSession
    rows = [(w, (w - 1 + d) % PERIOD) for w in range(1, PERIOD + 1) for d in range(-params.band_weeks, params.band_weeks + 1)]
    band_map = F.broadcast(spark.createDataFrame(sorted(set(rows)), "week int, residue int"))
    item = F.struct(*_CAND_FIELDS)
    band = pl.join(band_map, "residue").groupBy("unit_id", "week").agg(F.collect_list(item).alias("band"))
    whole = pl.groupBy("unit_id").agg(F.collect_list(item).alias("whole"))
    return band, whole


def _with_candidates(tg: DataFrame, band: DataFrame, whole: DataFrame) -> DataFrame:
    """Targets with their candidates ``c``: the band of the target's week; only targets whose band is empty are
    joined to their unit's whole pool."""
    j = tg.join(band.withColumnRenamed("week", "_w"), ["unit_id", "_w"], "left")
    empty = F.size(F.coalesce(F.col("band"), F.array())) <= 0
    filled = j.where(~empty).withColumnRenamed("band", "c")
    return filled.unionByName(j.where(empty).drop("band").join(whole.withColumnRenamed("whole", "c"), "unit_id", "left"))


def pool_sizes(tg: DataFrame, band: DataFrame, whole: DataFrame) -> DataFrame:
    """Candidates per target row: (unit_id, week_id, n_candidates, weight_sum)."""
    j, cands = _with_candidates(tg.withColumnRenamed("week", "_w"), band, whole), F.col("c")
    return j.select(
        "unit_id", "week_id", F.size(cands).cast("long").alias("n_candidates"),
        F.aggregate(cands, F.lit(0.0), lambda acc, c: acc + c["weight"]).alias("weight_sum"),
    )


def draw(tg: DataFrame, band: DataFrame, whole: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """For every target row pick the candidate with the smallest exponential
    key -ln(u)/w (ties by pool week id); u from md5 of (unit, target week
    id, pool week id). Same draw as ``weighted_draw``, evaluated inside the
    bounded candidate array of the target's week instead of a long join."""
    pw = F.pmod(F.least(F.col("week"), F.lit(PERIOD)) - 1, F.lit(PERIOD)) + 1
    j, cands = _with_candidates(tg.withColumn("_w", pw), band, whole), F.col("c")

    def keyed(c):
        u = hash_uniform(F.col("unit_id"), F.col("week_id"), c["p_week_id"], seed=params.seed)
        return F.struct((-F.log(u) / c["weight"]).alias("k"), c["p_week_id"].alias("p"), c.alias("c"))

    best = F.array_min(F.transform(cands, keyed))
    return j.select("unit_id", "year", "week", "week_id", best["c"].alias("d")).select(
        "unit_id", "year", "week", "week_id", *[F.col("d")[f].alias(f) for f in _CAND_FIELDS if f != "weight"]
    )


def _normal(*parts, seed: int):
    u1 = hash_uniform(*parts, F.lit("n1"), seed=seed)
    u2 = hash_uniform(*parts, F.lit("n2"), seed=seed)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2)


AR_BLOCK = 256


def ar1_path(tg: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """log-intensity x_t = rho * x_{t-1} + e_t per unit over its target weeks,
    e_t ~ N(0, sigma^2 (1 - rho^2)), x_{-1} ~ N(0, sigma^2). Returns
    (unit_id, week_id, log_f).

    Computed without a sequential loop: inside blocks of AR_BLOCK weeks,
    x_{s+j} = rho^(j+1) P + rho^j * sum_{i<=j} rho^(-i) e_{s+i} (a running
    window sum; the scale stays finite because j < AR_BLOCK), and the block
    start states P are chained over the few blocks of each unit."""
    rho, sigma = params.ar_rho, params.noise_sigma
    e = _normal("unit_id", "week_id", seed=params.seed) * (sigma * math.sqrt(1 - rho * rho))
    t = (F.row_number().over(unit_order()) - 1).cast("long")
    base = tg.select("unit_id", "week_id", e.alias("e")).withColumn("t", t)
    base = base.withColumn("b", F.floor(F.col("t") / AR_BLOCK)).withColumn("j", F.col("t") - F.col("b") * AR_BLOCK)
    run = Window.partitionBy("unit_id", "b").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = base.withColumn("s", F.sum(F.pow(F.lit(rho), -F.col("j").cast("double")) * F.col("e")).over(run))
    # per block: length L and the scaled sum at its end (a handful of rows per unit)
    ends = base.groupBy("unit_id", "b").agg(F.max_by("s", "t").alias("s_end"), F.count(F.lit(1)).alias("L"))
    x0 = tg.select("unit_id").distinct().select("unit_id", (_normal("unit_id", F.lit(-1), seed=params.seed) * sigma).alias("x0"))
    blocks = ends.groupBy("unit_id").agg(F.sort_array(F.collect_list(F.struct("b", "L", "s_end"))).alias("blk")).join(x0, "unit_id")
    init = F.struct(F.col("x0").alias("p"), F.array().cast("array<struct<b:bigint,p:double>>").alias("acc"))
    chain = F.aggregate(
        "blk", init,
        lambda acc, x: F.struct(
            (F.pow(F.lit(rho), x["L"].cast("double")) * acc["p"]
             + F.pow(F.lit(rho), (x["L"] - 1).cast("double")) * x["s_end"]).alias("p"),
            F.array_append(acc["acc"], F.struct(x["b"].cast("bigint").alias("b"), acc["p"].alias("p"))).alias("acc"),
        ),
    )
    starts = blocks.select("unit_id", F.explode(chain["acc"]).alias("z")).select("unit_id", F.col("z.b").alias("b"), F.col("z.p").alias("p"))
    j = base.join(starts, ["unit_id", "b"])
    jj = F.col("j").cast("double")
    log_f = F.pow(F.lit(rho), jj + 1) * F.col("p") + F.pow(F.lit(rho), jj) * F.col("s")
    return j.select("unit_id", "week_id", log_f.alias("log_f"))


def simulate(real: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Simulated base rows (BASE_COLUMNS + origin)."""
    tg = targets(real, params)
    band, whole = candidate_arrays(pool(real, params), params)
    drawn = draw(tg, band, whole, params)
    imap = F.create_map(*[x for y, f in params.year_intensity for x in (F.lit(int(y)), F.lit(float(f)))])
    base = drawn.withColumn("base", F.col("p_cases") * F.coalesce(F.element_at(imap, F.col("year")), F.lit(1.0)))
    w = Window.partitionBy("unit_id").orderBy("week_id").rowsBetween(-(params.smooth_window // 2), params.smooth_window // 2)
    base = base.withColumn("smooth", F.avg("base").over(w))
    sim = base.join(ar1_path(tg, params), ["unit_id", "week_id"])
    cases = F.greatest(F.rint(F.col("smooth") * F.exp("log_f")), F.lit(0.0)).cast("long")
    sim = sim.withColumn("cases", cases)
    geo = real.groupBy("unit_id").agg(*[F.min_by(c, "week_id").alias(c) for c in GEO_COLS])
    out = sim.join(geo, "unit_id", "left").select(
        "unit_id", *GEO_COLS, "year", "week", epi_week_start("year", "week").alias("week_start"), "week_id", "cases",
        *[F.when(F.col("cases") > 0, F.col(f"p_{c}")).alias(c) for c in AUX_COLS],
    )
    return out.withColumn("origin", F.lit(ORIGIN_SIMULATED))


def extend_panel(master: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Real rows plus simulated rows, with features, threshold, label and split
    recomputed on the joined series (simulated rows get split 'simulated';
    the split years come from real rows only)."""
    m = master if "origin" in master.columns else master.withColumn("origin", F.lit(ORIGIN_REAL))
    real = m.filter(F.col("origin") == ORIGIN_REAL).select(*BASE_COLUMNS, "origin")
    both = cut_lineage(real.unionByName(simulate(real, params)), "extended")
    feats = add_features(both, params.ma_window, params.season_length)
    return add_target_and_split(feats, params).select(*MASTER_COLUMNS)


def extension_summary(df: DataFrame) -> DataFrame:
    """Rows per origin, units and cases simulated, simulated date range, last
    real year and the cut date (last real date when anything is simulated)."""
    sim = F.col("origin") == ORIGIN_SIMULATED
    real = F.col("origin") == ORIGIN_REAL
    g = df.agg(
        F.count_if(sim).alias("simulated_rows"), F.count_if(real).alias("real_rows"),
        F.countDistinct(F.when(sim, F.col("unit_id"))).alias("simulated_units"),
        F.coalesce(F.sum(F.when(sim, F.col("cases"))), F.lit(0)).cast("long").alias("simulated_cases"),
        F.min(F.when(sim, F.col("week_start"))).alias("simulated_from"),
        F.max(F.when(sim, F.col("week_start"))).alias("simulated_to"),
        F.max(F.when(real, F.col("year"))).alias("last_real_year"),
        F.max(F.when(real, F.col("week_start"))).alias("_last_real"),
        F.bool_or(sim).alias("has_simulation"),
    )
    return g.withColumn("cut_date", F.when(F.col("has_simulation"), F.col("_last_real"))).drop("_last_real")


def series_segments(series: DataFrame, cut_date_col: str = "cut_date") -> DataFrame:
    """Observed part (dates <= cut) and projected part (dates >= cut; the cut
    week is in both) of weekly series, given a one-row table with the cut."""
    obs = series.filter(F.col("week_start") <= F.col(cut_date_col)).withColumn("segment", F.lit("observed"))
    proj = series.filter(F.col("week_start") >= F.col(cut_date_col)).withColumn("segment", F.lit("projected"))
    return obs.unionByName(proj).drop(cut_date_col)
