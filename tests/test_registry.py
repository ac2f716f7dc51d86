import datetime

import pytest

from pyspark.sql import functions as F

from weekpanel.operators import registry as RG
from weekpanel.schema import CASE_REGISTRY, QUERY_REGISTRY

T1 = datetime.datetime(2026, 1, 1)
T2 = datetime.datetime(2026, 1, 2)
BASE = dict(unit_id="000907", region="NORTH", province="COAST", district="HARBOUR", year=2031, week=7, cases=58, note="first entry")


def _batch(spark, rows):
    return spark.createDataFrame(rows)


def _one(spark):
    return RG.append(RG.empty(spark, CASE_REGISTRY), _batch(spark, [BASE]), CASE_REGISTRY, T1)


def test_create_returns_id_and_stamps(spark):
    r = _one(spark).collect()[0]
    assert r.id == 1 and r.created_at == T1 and r.updated_at == T1 and r.cases == 58


def test_bulk_and_empty(spark):
    rows = [dict(BASE, week=w, cases=2 * w) for w in range(1, 16)]
    t = RG.append(_one(spark), _batch(spark, rows), CASE_REGISTRY, T2, ["week"])
    ids = [r.id for r in t.orderBy("id").collect()]
    assert ids == list(range(1, 17))
    empty = spark.createDataFrame([], CASE_REGISTRY)
    assert RG.append(t, empty, CASE_REGISTRY, T2).count() == 16


def test_update_only_one(spark):
    rows = [dict(BASE, week=w) for w in range(1, 4)]
    t = RG.append(RG.empty(spark, CASE_REGISTRY), _batch(spark, rows), CASE_REGISTRY, T1, ["week"])
    ch = spark.createDataFrame([(2, 99)], "id long, cases long")
    out = {r.id: r for r in RG.update(t, ch, CASE_REGISTRY, T2).collect()}
    assert out[2].cases == 99 and out[2].updated_at == T2
    assert out[1].cases == 58 and out[1].updated_at == T1
    unknown = spark.createDataFrame([(77, 1)], "id long, cases long")
    assert sorted(r.cases for r in RG.update(t, unknown, CASE_REGISTRY, T2).collect()) == [58, 58, 58]


def test_delete_one_and_all(spark):
    rows = [dict(BASE, week=w) for w in range(1, 4)]
    t = RG.append(RG.empty(spark, CASE_REGISTRY), _batch(spark, rows), CASE_REGISTRY, T1, ["week"])
    assert sorted(r.id for r in RG.delete(t, spark.createDataFrame([(2,)], "id long")).collect()) == [1, 3]
    assert RG.delete_all(t).count() == 0


def test_unknown_columns_dropped(spark):
    t = RG.append(RG.empty(spark, CASE_REGISTRY), _batch(spark, [dict(BASE, made_up=1)]), CASE_REGISTRY, T1)
    assert "made_up" not in t.columns


def test_list_newest_first(spark):
    t = RG.append(_one(spark), _batch(spark, [dict(BASE, week=11)]), CASE_REGISTRY, T2)
    assert [r.id for r in RG.list_all(t).collect()] == [2, 1]


def test_json_field_roundtrip_and_two_tables(spark):
    q = spark.createDataFrame([('{"cases": 7.0, "cases_lag_1": 3.0, "week": 5}',), ("not json",)], "inputs string")
    out = RG.json_roundtrip(q, "inputs").collect()
    assert out[0].inputs_map == {"cases": 7.0, "cases_lag_1": 3.0, "week": 5.0}
    assert out[1].inputs_map is None and out[1].inputs_text == "not json"
    batch = spark.createDataFrame([("NORTH", "COAST", 5, "logistic_regression", {"cases": 7.0}, 0.61, "high")],
                                  "region string, district string, week int, model string, inputs map<string,double>, probability double, prediction string")
    reg2 = RG.append(RG.empty(spark, QUERY_REGISTRY), batch, QUERY_REGISTRY, T1)
    assert reg2.collect()[0].inputs == {"cases": 7.0}
    assert _one(spark).count() == 1


@pytest.mark.parametrize("partitions", [1, 8, 200])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_append_is_dense_at_any_size(spark, partitions, adaptive):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        n = 300_000
        batch = spark.range(n).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("unit_id"), F.col("id").cast("long").alias("cases"), F.lit(5).alias("week"))
        t = RG.append(_one(spark), batch, CASE_REGISTRY, T2, ["unit_id"])
        got = t.where("unit_id != '000907' or length(unit_id) = 9").where("note is null")
        r = got.agg(F.count("*"), F.count_distinct("id"), F.min("id"), F.max("id"), F.sum((F.col("id") != F.col("cases") + 2).cast("int"))).first()
        assert tuple(r) == (n, n, 2, n + 1, 0)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_update_overlays_each_row_and_keeps_ids_unique(spark):
    t = RG.append(RG.empty(spark, CASE_REGISTRY), _batch(spark, [dict(BASE, week=w) for w in (1, 2, 3)]), CASE_REGISTRY, T1, ["week"])
    ch = spark.createDataFrame([(1, 5, None), (2, None, "x"), (1, None, "y")], "id long, cases long, note string")
    out = {r.id: (r.cases, r.note) for r in RG.update(t, ch, CASE_REGISTRY, T2).collect()}
    assert out == {1: (5, "y"), 2: (58, "x"), 3: (58, "first entry")}
    ch = spark.createDataFrame([(1, None, ["note"])], "id long, note string, given array<string>")
    assert {r.id: r.note for r in RG.update(t, ch, CASE_REGISTRY, T2).collect()}[1] is None


def test_json_values_that_are_not_numbers(spark):
    q = spark.createDataFrame([('{"k": 1, "s": "x", "n": {"a": [1, 2]}}',)], "inputs string")
    out = RG.json_roundtrip(q, "inputs").first()
    assert out.inputs_any == {"k": "1", "s": "x", "n": '{"a":[1,2]}'} and out.inputs_text.startswith('{"k": 1')


def test_long_unit_keys_stay_apart(spark):
    from weekpanel.sources.adapters import unit_key

    got = [r[0] for r in spark.createDataFrame([(7,), (123456,), (1234567,), (12345678,)], "k long").select(unit_key(F.col("k"))).collect()]
    assert got == ["000007", "123456", "1234567", "12345678"]
