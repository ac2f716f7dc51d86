"""Line dedup and source mix against their DuckDB SQL, URL filter against brute force."""

from collections import Counter
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import documents, frame
from weekpanel.llm import line_dedup, mixing, url_filter


def in_duckdb(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    return Counter(tuple(sorted(dict(zip(names, r, strict=True)).items())) for r in res.fetchall())


def in_spark(df):
    return Counter(tuple(sorted(r.asDict().items())) for r in df.collect())


@pytest.mark.parametrize("seed", [3, 8])
def test_line_dedup_is_its_sql(spark, seed):
    rows = documents(seed)
    out = line_dedup.dedup_lines(frame(spark, rows, extra=True)).select("doc_id", "text", "n_lines", "n_removed")
    assert out.agg(F.sum("n_removed")).first()[0] > 0
    assert in_spark(out) == in_duckdb(rows, line_dedup.dedup_sql())


def test_line_dedup_keeps_first_and_columns(spark):
    passage = "\n".join(f"common {i}" for i in range(30))
    rows = [(i, f"own {i}\n{passage}\nend {i}", "en", "s", 1) for i in (4, 2, 9)]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, rows, extra=True)).collect()}
    assert out[2].n_removed == 0 and out[2].text == rows[1][1]
    assert out[4].n_removed > 20 and out[9].n_removed > 20 and out[9].text.startswith("own 9") and "component" in out[9].asDict()
    assert line_dedup.dedup_lines(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("seed,buckets", [(3, 4096), (5, 4)])
def test_mix_is_its_sql(spark, seed, buckets):
    rows = documents(seed)
    out = mixing.fair_mix(frame(spark, rows, extra=True), buckets=buckets)
    assert in_spark(out) == in_duckdb(rows, mixing.mix_sql())


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 9), "en", f"s{min(i % 8, 3)}", 0) for i in range(2000)]
    out = mixing.fair_mix(frame(spark, rows)).toPandas()
    assert (out.taken <= 2 * out["size"]).all()
    assert abs(out.taken.sum() - 1.5 * out["size"].sum()) < 20
    per = out.groupby(["source_size", "target"]).taken.sum().reset_index()
    assert ((per.taken - per.target).abs() < 40).all()


def test_mix_of_nothing(spark):
    assert mixing.fair_mix(frame(spark, documents()).limit(0)).count() == 0
    blank = mixing.fair_mix(frame(spark, [(1, None, None, None, None), (2, " ", "", "a", 0)])).collect()
    assert {(r.doc_id, r.size, r.target, r.taken) for r in blank} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


URLS = ["http://a.example.net/en/1", "https://B.Example.NET/en", "http://example.net/en/x?q=1", "http://example.net", "http://x.net/", "http://example.com/de/9",
        "http://m.example.com/de/", "http://m.example.com/en/7", "ftp://q.org/fr/a#b", "http://q.org/en/a", "http://q.org?x=/fr/", "no scheme", "", None,
        "http://", "http:///path", "x://y://z/fr/", "http://badexample.net/en/1", "HTTP://\u00c9XAMPLE.org/fr/", "http://spam.example.org/fr/1?utm=2&page=3"]


def rule_of(host, path):
    best = None
    for verdict, rule in url_filter.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best


def test_urls_against_brute_force(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS * 3)] + [
        (100 + 9 * i + j, f"http://h{i % 4}.example.{('net', 'com', 'org')[j % 3]}/{('en', 'de', 'fr')[j // 3]}/{i}", None) for i in range(60) for j in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string").withColumn("host", F.lit(1))
    out = {r.page_id: r for r in url_filter.judge_urls(df, min_support=0.05, min_confidence=0.8).collect()}
    assert len(out) == len({r[0] for r in rows})
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, u, _ in rows:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = rest
        for c in "/?#":
            host = host.split(c, 1)[0]
        path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
        host = host.translate(lower)
        assert (out[i].host, out[i].path) == (host, path)
        rule = rule_of(host, path)
        assert out[i].rule == (rule[1] if rule else None)
        assert out[i].verdict == (rule[0] if rule else out[i].verdict)
    assert all(r.verdict in ("allow", "block") for r in out.values())


def test_rules_against_enumeration(spark):
    rows = [(["a", "b"], "block")] * 6 + [(["a", "c"], "allow")] * 5 + [(["b", "c"], "block")] * 3 + [(["a"], "allow")] * 2 + [(["a", "b", "c"], "allow")]
    got = {(tuple(r.tokens), r.label): (r.confidence, r.support) for r in url_filter.mine_rules(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.15, 0.7).collect()}
    want, n = {}, len(rows)
    for size in (1, 2, 3):
        for t in combinations("abc", size):
            have = [label for tokens, label in rows if set(t) <= set(tokens)]
            for label in ("allow", "block"):
                k = have.count(label)
                if k and k / n >= 0.15 and k / len(have) >= 0.7:
                    if not any(set(s) < set(t) and lb == label and c >= round(k / len(have), 9) for (s, lb), (c, _) in want.items()):
                        want[(t, label)] = (round(k / len(have), 9), round(k / n, 9))
    assert got == want


def test_rules_of_many_tokens_and_deep_hosts(spark):
    """A rule that is sure only with four tokens; tokens that always stand together, 40 of them, mine as fast as one."""
    rows = []
    for mask in range(16):
        tokens = sorted(f"t{j}" for j in range(4) if mask >> j & 1)
        rows += [(tokens, "block" if mask == 15 else "allow")] * 10
    rows += [(sorted(f"host:{j:02d}" for j in range(40)), "block")] * 40
    df = spark.createDataFrame(rows, "tokens array<string>, label string")
    got = {(tuple(r.tokens), r.label) for r in url_filter.mine_rules(df, 0.04, 0.9).collect()}
    assert {t for t, label in got if label == "block"} == {("t0", "t1", "t2", "t3")} | {(f"host:{j:02d}",) for j in range(40)}
    deep = ".".join(f"l{j}" for j in range(30))
    urls = [(i, f"http://{deep}.fine.org/fr/{i}") for i in range(20)] + [(90, "http://x.fine.org/en"), (91, "http://x.other.com/en"), (92, f"http://{deep}.fine.org/en")]
    out = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(urls, "page_id long, url string")).collect()}
    assert len(out) == len(urls) and {out[i].rule for i in range(20)} == {"org/fr/"}
    # every suffix of the deep host is a rule of its own, equally sure; the last in order decides
    assert [(out[i].verdict, out[i].mined) for i in (90, 91, 92)] == [("allow", "host:org"), ("allow", None), ("allow", "sub:l0")]


def test_urls_of_nothing(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    only_unlabelled = spark.createDataFrame([(1, "http://a.com/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge_urls(only_unlabelled).collect()} == {"allow"}


def test_line_dedup_compares_bytes(spark):
    """A digest that is the same for most chunks changes nothing: chunks are told apart by their bytes."""
    rows = documents(4)
    weak = line_dedup.dedup_lines(frame(spark, rows), digest=lambda body: F.length(body) % 3).select("doc_id", "text", "n_lines", "n_removed")
    assert in_spark(weak) == in_duckdb(rows, line_dedup.dedup_sql())


def test_mix_spreads_rows_without_ids(spark):
    """Rows of one source without ids fall into many buckets of the shuffled order, and the result is its SQL's."""
    rows = [(None, f"word{i} " * (1 + i % 7), "en", "hot", 0) for i in range(600)] + [(i, "a b c", "en", "cold", 0) for i in range(60)]
    assert in_spark(mixing.fair_mix(frame(spark, rows), buckets=64)) == in_duckdb(rows, mixing.mix_sql())
