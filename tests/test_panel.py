from pyspark.sql import functions as F

from tests.fixtures import QUIET, busy_rows, quiet_rows, raw_cases
from weekpanel.operators.clean import clean_cases
from weekpanel.params import Params
from weekpanel.plans.master import build_master
from weekpanel.schema import FEATURE_NUMERIC, MASTER_COLUMNS, TARGET

P = Params(min_history_weeks=10)


def _master(spark):
    return build_master(raw_cases(spark), P).cache()


def test_duplicates_kept_and_input_unchanged(spark):
    raw = raw_cases(spark)
    n = raw.count()
    assert n == sum(busy_rows(y, w) + quiet_rows(y, w) for y in range(2014, 2020) for w in range(1, 51))
    assert clean_cases(raw, P).count() == n
    assert raw.count() == n


def test_master_shape_and_key(spark):
    m = _master(spark)
    assert m.columns == MASTER_COLUMNS
    assert m.groupBy("unit_id", "week_start").count().filter("count > 1").count() == 0
    # dates strictly increase per unit
    w = m.select("unit_id", "week_id", "week_start").orderBy("unit_id", "week_id").collect()
    for a, b in zip(w, w[1:]):
        if a.unit_id == b.unit_id:
            assert b.week_start > a.week_start


def test_zero_filled_weeks(spark):
    m = _master(spark)
    # the quiet unit's empty weeks exist with 0 cases and NULL means
    zeros = m.filter((F.col("unit_id") == QUIET) & (F.col("cases") == 0))
    assert zeros.count() > 0
    assert zeros.filter(F.col("age_mean").isNotNull()).count() == 0


def test_lags_use_no_future(spark):
    m = _master(spark).orderBy("unit_id", "week_id").collect()
    by = {}
    for r in m:
        by.setdefault(r.unit_id, []).append(r)
    for rows in by.values():
        for i, r in enumerate(rows):
            if i >= 1:
                assert r.cases_lag_1 == rows[i - 1].cases
            else:
                assert r.cases_lag_1 is None
            if i >= 4:
                assert abs(r.roll_mean_4 - sum(x.cases for x in rows[i - 4:i]) / 4) < 1e-9
            else:
                assert r.roll_mean_4 is None


def test_target_binary_and_not_a_feature(spark):
    m = _master(spark)
    vals = {r[0] for r in m.select(TARGET).distinct().collect()}
    assert vals <= {0, 1, None}
    assert TARGET not in FEATURE_NUMERIC


def test_split_years(spark):
    m = _master(spark)
    got = {r.split: (r.lo, r.hi) for r in m.groupBy("split").agg(F.min("year").alias("lo"), F.max("year").alias("hi")).collect()}
    assert got["test"] == (2019, 2019) and got["val"] == (2018, 2018) and got["train"][1] == 2017


def test_raw_file_with_documented_header(spark, tmp_path):
    """A file with a BOM and the documented header gives the right panel; one without the unit is refused."""
    import pytest

    from weekpanel.sources import io

    names = {v: k for k, v in io.DOCUMENTED_HEADER.items()}
    raw = raw_cases(spark)
    rows = raw.collect()
    text = ";".join(f" {names[c].upper()} " if i % 2 else names[c] for i, c in enumerate(raw.columns)) + "\n"
    text += "\n".join(";".join(x or "" for x in r) for r in rows)
    f = tmp_path / "cases.csv"
    f.write_bytes(b"\xef\xbb\xbf" + text.encode())
    back = io.read_raw_csv(spark, str(f))
    assert clean_cases(back, P).count() == len(rows)
    got = build_master(back, P).select("unit_id", "week_id", "cases").collect()
    want = _master(spark).select("unit_id", "week_id", "cases").collect()
    assert sorted(got) == sorted(want)
    (tmp_path / "bad.csv").write_text("a;b\n1;2\n")
    with pytest.raises(ValueError, match="unit_id"):
        io.read_raw_csv(spark, str(tmp_path / "bad.csv"))
    own = io.read_raw_csv(spark, str(tmp_path / "bad.csv"), mapping={"a": "unit_id", "b": "year"}, required=("unit_id", "year"))
    assert own.first().unit_id == "1"


def test_saved_panel_models_and_meta(spark, tmp_path):
    from weekpanel.plans.master import load_or_build_master
    from weekpanel.sources import io

    path = str(tmp_path / "panel")
    first = load_or_build_master(spark, path, raw_cases(spark), extend=False, params=P)
    again = load_or_build_master(spark, path, None, params=P)
    assert sorted(first.select("unit_id", "week_id", "cases").collect()) == sorted(again.select("unit_id", "week_id", "cases").collect())
    assert io.read_optional(spark, str(tmp_path / "none")) is None and io.load_model(str(tmp_path / "none")) is None
    assert io.artifacts_ready(spark, [path]) and not io.artifacts_ready(spark, [path, str(tmp_path / "none")])
    io.save_meta(spark, {"best": "x", "threshold": 0.5}, str(tmp_path / "meta"))
    assert io.load_meta(spark, str(tmp_path / "meta")) == {"best": "x", "threshold": 0.5}
    assert io.load_meta(spark, str(tmp_path / "none")) is None


def test_ranks_and_quantiles(spark):
    import numpy as np

    from weekpanel.operators import eda, ranks

    rng = np.random.default_rng(5)
    rows = [(i, "ab"[i % 2], float(rng.integers(0, 50)), float(rng.normal()) if i % 9 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, g string, x double, y double").repartition(7)
    got = {r.column: (r.q0, r.q1) for r in ranks.exact_quantiles(df, ["x", "y"], [0.25, 0.9]).collect()}
    for k, c in ((2, "x"), (3, "y")):
        v = [r[k] for r in rows if r[k] is not None]
        assert np.allclose(got[c], np.quantile(v, [0.25, 0.9]))
    upto = {r.i: r.x_upto for r in ranks.running_total(df, ["g"], ["i"], ["x"]).collect()}
    for g in "ab":
        mine = [r for r in rows if r[1] == g]
        assert np.allclose([upto[r[0]] for r in mine], np.cumsum([r[2] for r in mine]))
    groups = ranks.equal_groups(df, ["i"], 7, "k").orderBy("i").collect()
    assert [r.k for r in groups] == [k for k, part in enumerate(np.array_split(range(500), 7)) for _ in part]
    far = spark.createDataFrame([("u", i, v) for i, v in enumerate([5, 6, 7, 6, 5, 90, 6])], "unit_id string, week_id long, cases long")
    assert [(r.week_id, r.side) for r in eda.outlier_points(far).collect()] == [(5, "high")]


def test_queries_write_only_the_panel_columns_they_read(spark, monkeypatch):
    from weekpanel.plans import analysis_queries as AQ
    from weekpanel.plans import catalog as CT
    from weekpanel.plans import table_queries as TQ
    from weekpanel.schema import RAW_CASES

    rows = [("ASIA", "P", f"D{u}", "DENGUE GRAVE", str(1995 + i // 52), str(i % 52 + 1), f"00000{u}", "30", "A", "F", None, None, None, None)
            for u in (1, 2) for i in range(0, 156, 1 + u)]
    raw = spark.createDataFrame(rows, RAW_CASES)
    written, real = [], CT.cut_lineage
    monkeypatch.setattr(CT, "supplier_cases", lambda *_: raw)
    monkeypatch.setattr(CT, "cut_lineage", lambda df, name="stage": written.append(df.columns) or real(df, name))
    whole = CT.master(spark, "")
    assert written.pop() == whole.columns
    series = AQ.real_series(spark, "")
    assert written.pop() == CT.SERIES_COLS and not written
    got = CT.q_describe_cases(spark, "").where("column = 'cases'").first()
    assert written.pop() == CT.DESCRIBE_COLS and not written
    assert got["count"] == whole.count() == series.where("level = 'unit'").count()
    assert TQ._frame(spark, "").count() == whole.where("target IS NOT NULL").count() and not written


def test_modal_geography_stacks_spellings_not_unit_weeks(spark):
    from weekpanel.operators.panel import modal_geography

    rows = [("a", " x", "p", None, 2), ("a", "X", "p", None, 1), ("a", "y", "q", None, 2), ("b", None, "r", "d", 1), (None, "z", "r", "e", 1)]
    groups = spark.createDataFrame(rows, "unit_id string, region string, province string, district string, n long")
    geo = modal_geography(groups, fold=True)
    got = {r["unit_id"]: (r["region"], r["province"], r["district"]) for r in geo.collect()}
    assert got == {"a": ("X", "P", None), "b": (None, "R", "D"), None: ("Z", "R", "E")}
    below = geo._jdf.queryExecution().optimizedPlan().toString().split("Generate", 1)[1]
    assert "Aggregate" in below  # summed up before the columns are stacked


def test_panel_units_are_dealt_by_rows(spark, monkeypatch):
    from weekpanel.params import Params
    from weekpanel.plans import master as M
    from weekpanel.schema import RAW_CASES

    rows = [("ASIA", "P", f"D{u}", "DENGUE GRAVE", str(2001 + i // 52), str(i % 52 + 1), f"{u:06d}", "30", "A", "F", None, None, None, None)
            for u in range(40) for i in range(0, 156, 5)]  # 152 weeks each (a year ends with its last observed week)
    raw = spark.createDataFrame(rows, RAW_CASES)
    whole = sorted(map(str, M.build_master(raw, Params()).collect()))
    monkeypatch.setattr(M, "ROWS_PER_TASK", 100)
    panel = M.build_master(raw, Params())
    sizes = [r["n"] for r in panel.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 40 * 152 == len(whole) and len(sizes) > 20 and max(sizes) <= 8 * 152
    assert sorted(map(str, panel.collect())) == whole


def test_named_columns_group_cases_by_what_they_need(spark, monkeypatch):
    from weekpanel.operators.classify import FRAME_READS
    from weekpanel.plans import master as M

    whole, groups = _master(spark), []
    monkeypatch.setattr(M, "case_groups", lambda cases, make=M.case_groups: groups.append(make(cases)) or groups[-1])
    for columns, keys in ((FRAME_READS, ["region"]), (["unit_id", "week_id", "cases"], []), (["unit_id", "week_id", "district", "warn_share"], ["district", "disease"])):
        part = build_master(raw_cases(spark), P, columns=columns)
        assert part.columns == columns
        assert groups[-1].columns[3:] == [*keys, "n"]
        assert sorted(map(repr, part.collect())) == sorted(map(repr, whole.select(*columns).collect()))


def test_trailing_columns_need_whole_windows(spark):
    import statistics

    from weekpanel.operators.features import add_features

    cases = {"a": [3, 0, 7, 7, 1, 2, 9, 4, 4, 0, 11], "b": [5, None, 2, 2, 8, 1, 0, 6, 6, 6, 6, 3], "c": [1, 2]}
    rows = [(u, i, 1 + i, n) for u, all_n in cases.items() for i, n in enumerate(all_n)]
    panel = spark.createDataFrame(rows, "unit_id string, week_id long, week int, cases long")
    feats = add_features(panel)
    # the count and the mean of a window are not taken by sliding over it
    assert feats._jdf.queryExecution().optimizedPlan().toString().count("stddev_samp(") == 1
    assert "avg(" not in feats._jdf.queryExecution().optimizedPlan().toString()
    for r in feats.collect():
        for k, got in ((4, r.roll_mean_4), (8, r.roll_mean_8)):
            before = cases[r.unit_id][max(0, r.week_id - k) : r.week_id]
            want = sum(before) / k if len(before) == k and None not in before else None
            assert got == want
        before = cases[r.unit_id][max(0, r.week_id - 4) : r.week_id]
        assert (r.roll_std_4 is None) == (len(before) < 4 or None in before)
        assert r.roll_std_4 is None or abs(r.roll_std_4 - statistics.stdev(before)) < 1e-12
