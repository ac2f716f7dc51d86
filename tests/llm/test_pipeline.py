import random

import corpus_pipeline as P
import __spark_entry__ as E
from tests.llm.corpus import frame, words
from weekpanel.llm import queries


def test_every_operator_is_registered():
    names = [k for k in E.queries() if k.startswith("op")]
    assert {int(k[2:].split("_")[0]) for k in names} == set(range(1, 14)) and "pipeline" in E.queries()
    assert set(queries.ORACLE) == {"op6_line_dedup", "op8_source_mix", "op11_ranked_search"}


def test_pipeline_against_planted_rows(spark, tmp_path):
    """Toxic rows, copies and leaks go, repeated chunks are cut, the mix meets its targets; clean rows reach the mix."""
    rng = random.Random(9)
    bad = ["vile", "rotten", "nasty", "foul", "awful"]
    item = " ".join(words(rng, 30))
    passage = "\n".join(" ".join(words(rng, 7)) for _ in range(20))
    rows = []
    for i in range(400):
        w = words(rng, rng.randrange(30, 80))
        rows.append([i, " ".join(w), "en", f"s{i % 3}", 0])
    toxic = set(range(0, 400, 10))
    for i in toxic:
        rows[i][1] += " " + " ".join(rng.sample(bad, 4))
    for i in (51, 151):
        rows[i][1] = rows[i][1] + "\n" + passage + "\nend " + str(i)
    rows[153][1] = "\n".join(" ".join(words(rng, 12)) for _ in range(2))  # nothing but lines that stand in 52 too
    rows[52][1] = rows[52][1] + "\n" + rows[153][1] + "\nend 52"
    rows[62][1] = rows[61][1]  # exact copy
    w = rows[71][1].split()
    w[0] = "edited"
    rows[72][1] = " ".join(w)  # near copy
    rows[83][1] = rows[83][1] + " " + item
    rows = [tuple(r) for r in rows] + [(500, None, None, None, None), (501, "", "en", "s0", 0), (None, "no id at all here now", "en", "s1", 0)]
    d = str(tmp_path)
    frame(spark, rows, extra=True).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{d}/documents.parquet"), {}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, d)
        if k < len(P.STAGES) - 1:
            assert out.columns == list(P.COLUMNS)
        out.write.parquet(f"{d}/{k}")
        docs = spark.read.parquet(f"{d}/{k}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
    gone = {r[0] for r in rows} - set(seen["toxicity"])
    assert gone <= toxic and len(gone) > 0.9 * len(toxic)
    assert set(seen["toxicity"]) - set(seen["line dedup"]) == {153} and {500, 501} <= set(seen["line dedup"])
    assert len(seen["line dedup"][151].text) < len(seen["toxicity"][151].text) and seen["line dedup"][51].text == seen["toxicity"][51].text
    assert set(seen["line dedup"]) - set(seen["near duplicates"]) == {62, 72}
    assert set(seen["near duplicates"]) - set(seen["decontamination"]) == {83}
    assert set(seen["source mix"]) <= set(seen["decontamination"]) and all(1 <= r.repeats <= 2 for r in seen["source mix"].values())
    whole = P.run(spark, d)
    assert sorted((r.doc_id or -1, r.repeats) for r in whole.collect()) == sorted((k or -1, r.repeats) for k, r in seen["source mix"].items())


def test_passages_of_few_lines_go_among_differing_neighbours(spark):
    """Passages of over 50 words on one to three lines stay once, whatever stands beside them."""
    rng = random.Random(12)
    passages = [[" ".join(words(rng, k)) for k in sizes] for sizes in ((55,), (120,), (27, 28), (40, 12), (17, 17, 18), (30, 11, 13)) for _ in range(4)]
    rows = []
    for k, passage in enumerate(passages):
        for j in range(5):
            before, after = ([" ".join(words(rng, rng.randrange(1, 14))) for _ in range(rng.randrange(1, 4))] for _ in range(2))
            rows.append((10 * k + j, "\n".join([*before, *passage, *after]), "en", "s", 0))
    rows += [(1000 + j, passages[0][0], "en", "s", 0) for j in range(2)]  # whole documents: the next stage's
    out = {r.doc_id: r.text for r in P.dedup_lines(spark, frame(spark, rows), "").collect()}
    assert out[1000] == out[1001] == passages[0][0]
    for k, passage in enumerate(passages):
        for line in passage:
            assert [j for j in range(5) if line in out[10 * k + j].split("\n")] == ([0] if k else [])
    for k, text, *_ in rows[:-2]:
        assert [x for x in text.split("\n") if x not in passages[k // 10]] == [x for x in out[k].split("\n") if x not in passages[k // 10]]
