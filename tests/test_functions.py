import datetime

from pyspark.sql import functions as F

from weekpanel.functions.calendar import epi_week, epi_week_start, epi_year
from weekpanel.functions.scalar import age_in_years, hash_uniform
from weekpanel.functions.text import normalize_text
from weekpanel.operators.forecast import future_weeks


def test_age_units(spark):
    df = spark.createDataFrame(
        [("24", "A"), ("12", "M"), ("365", "D"), ("200", "A"), ("-5", "A"), ("40", "A"), ("abc", "A"), ("7", "X")],
        "age string, unit string",
    )
    got = [r[0] for r in df.select(age_in_years("age", "unit")).collect()]
    assert got == [24.0, 1.0, 1.0, None, None, 40.0, None, 7.0]


def test_calendar_roundtrip(spark):
    pairs = [(y, w) for y in range(2020, 2028) for w in (1, 9, 22, 40, 52)]
    df = spark.createDataFrame(pairs, "year int, week int").withColumn("d", epi_week_start("year", "week"))
    back = df.select("year", "week", epi_year("d").alias("y2"), epi_week("d").alias("w2")).collect()
    assert all(r.year == r.y2 and r.week == r.w2 for r in back)
    dates = [r.d for r in df.orderBy("year", "week").collect()]
    assert dates == sorted(set(dates))


def test_future_weeks_wrap(spark):
    s = spark.createDataFrame([("national", "ALL", datetime.date(2026, 12, 17), 1.0)],
                              "level string, series_key string, week_start date, cases double")
    got = [r.week_start for r in future_weeks(s, 4).orderBy("step").collect()]
    assert got == [datetime.date(2026, 12, 24), datetime.date(2027, 1, 1), datetime.date(2027, 1, 8), datetime.date(2027, 1, 15)]


def test_text_folding(spark):
    df = spark.createDataFrame([("  San  Martín\t",), ("Ñandú",), ("straße",), ("ﬁn",), (None,), (" Ancash ",)], "t string")
    got = [r[0] for r in df.select(normalize_text("t")).collect()]
    assert got == ["SAN MARTIN", "NANDU", "STRASSE", "FIN", None, "ANCASH"]


def test_folding_equals_nfkd_on_every_code_point(spark):
    import unicodedata

    from weekpanel.functions.text import _fold

    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    # 64 code points to a text, and each one between two letters
    texts = ["".join(f"x{chr(c)}" for c in points[i : i + 64]) + "x" for i in range(0, len(points), 64)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(8)
    got = dict(df.select("i", _fold(F.col("t"))).collect())
    strip = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    assert [i for i, t in enumerate(texts) if got[i] != strip(t)] == []


def test_hash_uniform_is_stable(spark):
    df = spark.range(1000).select(hash_uniform("id", seed=7).alias("u"))
    a = [r.u for r in df.collect()]
    b = [r.u for r in df.repartition(5).orderBy(F.col("u")).collect()]
    assert all(0 < x < 1 for x in a)
    assert sorted(a) == b
