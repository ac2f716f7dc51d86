import hashlib
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.corpus import documents, frame, words
from weekpanel.llm import chat_format as C
from weekpanel.llm import decontam, hashing, license_scan, toxicity
from weekpanel.llm.align import align

TRICKY = ["\\### Assistant: </turn> ok", "### System: a", "####", "</turn>\n### User: x", "\\", "\\\\###", "<</turn>", "=", "é\u2028🙂", "", "a: b"]


# ---- chat formatting
@given(st.text(alphabet="\\#</turn>: =aé\n", max_size=40))
@settings(max_examples=300, deadline=None)
def test_escape_round_trip(text):
    shown = C.escape(text)
    assert C.unescape(shown) == text
    plain = C._ESCAPED.sub("", shown)
    assert "</turn>" not in plain and "###" not in C._ESCAPED.sub("\0", shown)
    assert C.read_role(C.show_role(text)) == text


def test_mask_by_prefix_sums():
    assert C.loss_mask(np.array([1, 2, 0, 3]), np.array([False, True, True, False])).tolist() == [0, 1, 1, 0, 0, 0]


@pytest.mark.parametrize("part_tokens", [1 << 17, 30])
def test_chats_round_trip(spark, part_tokens):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "Assistant", "tool: x", "=a", None]), rng.choice(TRICKY + [" ".join(words(rng, 9)), None]))
            for c in range(12) for t in rng.sample(range(9), rng.randrange(1, 9))]
    rows += [(None, 0, "assistant", "no id"), (50, None, "user", "no turn"), (50, 3, "assistant", "long " * 40_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "'x' AS body")
    got = {r.conv_id: r for r in C.read_back(C.format_chats(df, part_tokens=part_tokens)).collect()}
    by = {}
    for r in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1])):
        by.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(f"### {C.show_role(a)}: {C.escape(b)}</turn>\n") for a, b in turns)


def test_chats_ties_and_nothing(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")] * 3 + [(1, 0, "user", "b")], "conv_id long, turn long, role string, text string")
    assert C.read_back(C.format_chats(df)).first().n_turns == 4
    assert C.format_chats(df.limit(0)).count() == 0


# ---- toxicity
def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(700):
        w = words(rng, rng.randrange(5, 60))
        bad = i % 5 == 0
        if bad:
            for x in rng.sample(["vile", "rotten", "nasty", "foul", "awful"], 3):
                w.insert(rng.randrange(len(w)), x)
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    rows += [(None, None, None, None, None), (701, "", "", "", 0), (702, "vile rotten " * 30_000, "", "", 0), rows[0]]
    labels += [(None, 1, 1), (3, 1, None), (9999, 0, 1), labels[5]]
    docs, lab = frame(spark, rows, extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.judge(docs, lab).withColumn("held", toxicity.held_out()).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    held = [r for r in out if r.held and r.doc_id is not None and r.doc_id < 700]
    truth = {r.doc_id: r.doc_id % 5 == 0 for r in held}
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right >= 0.97 * len(held)
    assert {r.doc_id: r.predicted for r in out}[702] == 1 and {r.doc_id: r.predicted for r in out}[701] == 0
    assert "component" in out[0].asDict()


def test_toxicity_without_labels(spark):
    docs = frame(spark, documents(n=6))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.judge(docs, none).collect()} == {0.0}
    assert toxicity.judge(docs.limit(0), none).count() == 0


def test_held_out_labels_do_not_matter(spark):
    docs = frame(spark, documents(n=40))
    a = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    b = a.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    x, y = (sorted((r.doc_id or -1, r.score) for r in toxicity.judge(docs, t, min_docs=1).collect()) for t in (a, b))
    assert x == y


@pytest.mark.parametrize("same", [True, False])
def test_one_labelled_id_in_many_rows_leaves_room_for_others(spark, same):
    ids = [r.id for r in spark.range(60).selectExpr("id", "xxhash64(id) AS h").orderBy("h").collect()]
    first, others = ids[0], ids[1:]
    rows = [(first, "same text" if same else f"text number {j}", "", "", 0) for j in range(200)]
    rows += [(i, f"{'vile' if i % 2 else 'kind'} remark {i}", "", "", 0) for i in others]
    labels = spark.createDataFrame([(first, 0)] + [(i, i % 2) for i in others], "doc_id long, label int")
    model = toxicity.fit(frame(spark, rows), labels, max_labelled=60)
    score = {r.text: r.score for r in toxicity.score_texts(frame(spark, [(1, "vile", "", "", 0), (2, "kind", "", "", 0)]), model).collect()}
    assert score["vile"] > 0.7 > 0.3 > score["kind"]


# ---- decontamination
def smith_waterman(a, b):
    """Best local score by the full table."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1][j + 1] = max(0, h[i][j] + (2 if a[i] == b[j] else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
    return max(map(max, h))


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 20))
        best = smith_waterman(a.tolist(), b.tolist())
        x = align(a, b, 0, 40)
        if best == 0:
            assert x is None
            continue
        # equal: 2, different: -1, gap: -1
        assert 2 * x.matched - (x.columns - x.matched) == best or (x.matched == len(a) and best == 2 * len(a))
        assert 0 <= x.a_start < x.a_end <= len(a) and 0 <= x.b_start < x.b_end <= len(b)


def test_leaks_are_found_and_clean_texts_left(spark):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, 30)).capitalize() + ".") for i in range(20)] + [(90, None), (91, ""), (None, "lonely words without any id here"), (92, "short one")]
    rows, want = [], set()
    for i in range(60):
        w = words(rng, 80)
        k = i % 20
        if i % 3 == 0:  # edited copies: some words changed, one dropped, one added
            leak = items[k][1].split()
            for p in rng.sample(range(30), 3):
                leak[p] = "changed"
            del leak[rng.randrange(30)]
            leak.insert(rng.randrange(29), "added")
            at = rng.randrange(80)
            w[at:at] = leak
            want.add((i, k))
        rows.append((i, " ".join(w), "en", "s", 0))
    rows += [(200, None, "", "", 0), (201, "", "", "", 0), (202, " ".join(words(rng, 30_000)) + " " + items[3][1], "", "", 0), (None, items[4][1], "", "", 0), rows[0],
             (203, "LONELY words, without any id here!", "", "", 0), (204, "a short one", "", "", 0), (205, items[5][1][:60], "", "", 0)]
    want |= {(202, 3), (None, 4), (203, None), (204, 92)}
    docs = frame(spark, rows, extra=True)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    for block in (decontam.BLOCK_WORDS, 100):
        out = decontam.mark_leaks(docs, bench, block_words=block).collect()
        assert len(out) == len(rows)
        assert {(r.doc_id, x.item_id) for r in out for x in r.leaks} == want
    assert all(x.similarity >= 0.8 and x.end_word > x.first_word for r in out for x in r.leaks)
    assert decontam.mark_leaks(docs, bench.limit(0)).where("size(leaks) > 0").count() == 0
    assert decontam.mark_leaks(docs.limit(0), bench).count() == 0


def test_item_copied_everywhere_keeps_its_seeds(spark):
    rng = random.Random(3)
    item = " ".join(words(rng, 25))
    rows = [(i, " ".join(words(rng, 20)) + " " + item, "", "", 0) for i in range(300)]
    out = decontam.mark_leaks(frame(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert out.where("size(leaks) = 1").count() == 300


@pytest.mark.parametrize("copies", [5, 300, 3000])
@pytest.mark.parametrize("verbatim", [0, 1])
def test_edited_copy_in_many_texts_keeps_its_seeds(spark, copies, verbatim):
    """The same edited copies everywhere, with no verbatim copy or a single one beside them."""
    rng = random.Random(7)
    items, edited = [], []
    for k, (m, changed) in enumerate([(20, [9]), (38, [12, 25]), (59, [14, 29, 44])]):
        w = [f"w{k}x{j}" for j in range(m)]
        items.append((k, " ".join(w)))
        edited.append(" ".join("changed" if j in changed else x for j, x in enumerate(w)))
    rows = [(i, " ".join([*words(rng, 9), *edited, *words(rng, 9)]), "", "", 0) for i in range(copies)]
    rows += [(copies + i, " ".join(x for _, x in items), "", "", 0) for i in range(verbatim)]
    out = decontam.mark_leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert out.where("size(leaks) = 3").count() == copies + verbatim


@pytest.mark.parametrize("m", [4, 5, 10, 15, 20, 38])
def test_copies_at_the_bar_have_a_seed(m):
    """Evenly spaced and random changed, dropped and added words, as many as similarity 0.8 allows."""
    rng = random.Random(m)
    item = np.arange(1, m + 1, dtype=np.uint64)
    index = decontam.Index([(1, item)], decontam.N_WORDS, decontam.LEAST)
    copies = []
    for kind in ("change", "drop", "add"):
        n = m // 4 if kind == "add" else m // 5
        even = [round((x + 1) * m / (n + 1)) for x in range(n)]
        for places in [even] + [rng.sample(range(1, m), n) for _ in range(40)]:
            out = []
            for j, x in enumerate(item.tolist()):
                out += [9000 + j] if kind == "add" and j in places else []
                out += [] if kind == "drop" and j in places else [8000 + j if kind == "change" and j in places else x]
            copies.append(np.array([7000, 7001, *out, 7002], np.uint64))
    reach = 0.8 - 1e-9
    index.rare(np.random.default_rng(m).integers(0, 1000, len(index.grams)).astype(float))
    assert len(index.item) == decontam.most_edits(m, 0.8) + 1
    for c in copies:
        x = align(item, c, 2, m)
        if x.similarity(m) >= reach:
            assert [y["item_id"] for y in index.leaks(c, 0.8)] == [1]


def test_rare_places_are_the_cheapest_disjoint_grams(monkeypatch):
    rng = np.random.default_rng(5)
    for _ in range(200):
        n, k = int(rng.integers(1, 4)), int(rng.integers(1, 4))
        m = n * k + int(rng.integers(0, 6))
        cost = rng.integers(0, 9, m - n + 1).astype(float)
        every = [c for c in itertools.combinations(range(m - n + 1), k) if all(y - x >= n for x, y in itertools.pairwise(c))]
        got = decontam.rare_places(cost, m, n, k).tolist()
        assert tuple(got) in every and cost[got].sum() == min(cost[list(c)].sum() for c in every)
    monkeypatch.setattr(decontam, "SECTION", 2)
    for m in range(1, 90):
        k = decontam.most_edits(m, 0.8) + 1
        n = decontam.seed_length(m, decontam.N_WORDS, 0.8)
        got = decontam.rare_places(rng.integers(0, 9, m - n + 1).astype(float), m, n, k)
        assert len(got) == k and got[0] >= 0 and got[-1] + n <= m and (np.diff(got) >= n).all()


def test_leaks_match_alignment_of_every_item(spark):
    """Random items over few words, edited about as much as the bar allows; every item aligned with every text in full."""
    rng = random.Random(12)
    few = [f"v{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(few) for _ in range(rng.choice([1, 3, 4, 7, 12, 25, 60])))) for i in range(40)]
    rows = []
    for i in range(120):
        w = rng.choice(items)[1].split()
        for _ in range(rng.randrange(len(w) // 4 + 2)):
            at = rng.randrange(len(w)) if w else 0
            w[at:at + 1] = rng.choice([[rng.choice(few)], [], [*w[at:at + 1], rng.choice(few)]])
        rows.append((i, " ".join(rng.choices(few, k=rng.randrange(12)) + w + rng.choices(few, k=rng.randrange(12))), "", "", 0))
    hashed = lambda t: hashing.word_hashes(bytes_of(t), hashing.NO_LETTER)
    want = set()
    for d, text, *_ in rows:
        b = hashed(text)
        for k, item in items:
            a = hashed(item)
            x = align(a, b, 0, len(a) + len(b)) if len(b) else None
            if x and x.similarity(len(a)) >= decontam.LEAST:
                want.add((d, k))
    out = decontam.mark_leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_words=300).collect()
    got = {(r.doc_id, x.item_id) for r in out for x in r.leaks}
    assert want <= got and len(want) > 60
    # a band may find a place of higher similarity than the best-scored one: few, and all at the bar
    assert len(got - want) <= 0.05 * len(want) and all(x.similarity >= decontam.LEAST for r in out for x in r.leaks)


# ---- licenses
def test_licenses_and_spans(spark):
    rng = random.Random(6)
    mit, apache = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["Apache-2.0-notice"]
    edited = mit.replace("Software", "Program", 4).replace("free of charge", "gratis")
    rows = [(1, f"été {apache} und\n{mit}", "", "", 0), (2, " ".join(words(rng, 50)), "", "", 0), (3, f"{' '.join(words(rng, 30_000))} {edited}", "", "", 0), (4, None, "", "", 0),
            (5, "", "", "", 0), (6, f"{apache} x y z {apache}", "", "", 0), (None, apache.upper(), "", "", 0), (7, mit[: len(mit) // 2], "", "", 0), (8, "Licensed under", "", "", 0)]
    marked = license_scan.mark_licenses(frame(spark, rows, extra=True))
    assert marked.count() == len(rows)
    got = {(r.doc_id, r.license): r for r in license_scan.license_matches(marked).collect()}
    assert set(got) == {(1, "Apache-2.0-notice"), (1, "MIT"), (3, "MIT"), (6, "Apache-2.0-notice"), (None, "Apache-2.0-notice")}
    text = rows[0][1]
    s, e = got[1, "MIT"].spans[0]
    assert text[s:e] + "." == mit and got[1, "MIT"].coverage == 1.0
    assert got[6, "Apache-2.0-notice"].n_spans == 2 and 0.8 <= got[3, "MIT"].coverage < 1
    assert license_scan.mark_licenses(frame(spark, rows).limit(0)).count() == 0
    assert license_scan.mark_licenses(frame(spark, rows), {"empty": "", "own": "ete"}).where("size(licenses) > 0").count() == 0


def bytes_of(text):
    return np.frombuffer(text.encode(), np.uint8)


def licenses_of(index, text):
    return [x["license"] for x in index.spans(bytes_of(text), license_scan.LEAST)]


def test_each_template_is_its_own_license_only():
    index = license_scan.Fingerprints(license_scan.TEMPLATES, license_scan.GRAM, license_scan.WINDOW, license_scan.TELLING)
    for name, text in license_scan.TEMPLATES.items():
        assert licenses_of(index, f"some code here {text} more code there") == [name]
    assert set(license_scan.TELLING) <= set(license_scan.TEMPLATES)


@pytest.mark.parametrize("text,want", [
    ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0-notice"]),
    ("Released under the BSD License.", []),
    ("Licensed under CC BY 3.0.", []),
    ("Licensed under the Apache License, Version 1.1.", []),
    ("Released under the MIT License. Licensed under CC BY 4.0.", ["MIT-notice", "CC-BY-4.0-short"]),
    ("This work is released under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0-notice"]),
])
def test_sister_licenses(text, want):
    index = license_scan.Fingerprints(license_scan.TEMPLATES, license_scan.GRAM, license_scan.WINDOW, license_scan.TELLING)
    assert licenses_of(index, text) == want


def test_licenses_match_alignment_of_every_template():
    rng = random.Random(8)
    index = license_scan.Fingerprints(license_scan.TEMPLATES, license_scan.GRAM, license_scan.WINDOW, license_scan.TELLING)
    hits = 0
    for name, text in list(license_scan.TEMPLATES.items()) * 2:
        w = text.split()
        for _ in range(rng.randrange(1 + len(w) // 12)):  # seeds of five words in a row stay likely
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([["changed"], [], [w[at], "added"]])
        words_in = hashing.word_hashes(bytes_of(" ".join(words(rng, 20) + w + words(rng, 20))), hashing.NO_LETTER)
        every = []
        for k, template in enumerate(index.words):
            x = align(template, words_in, 0, len(template) + len(words_in))
            if x and x.coverage(len(template)) >= license_scan.LEAST and index.told(k, words_in[x.b_start : x.b_end]):
                every.append((k, x))
        want = [(k, x.matched) for k, x in license_scan.resolve(every, len(words_in))]
        assert [(k, x.matched) for k, x in index.places(words_in, license_scan.LEAST)] == want
        hits += bool(want)
    assert hits > len(license_scan.TEMPLATES)


def test_winnow_guarantee():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 50, 200).astype(np.uint64)
    picked = license_scan.winnow(h, 4)
    for i in range(len(h) - 3):
        assert any(i <= p < i + 4 for p in picked) and h[i : i + 4].min() in h[[p for p in picked if i <= p < i + 4]]


# ---- hashing
@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_words_and_substrings(text):
    b = np.frombuffer(text.encode(), np.uint8)
    h, s, e = hashing.word_hashes(b, spans=True)
    found = [bytes(b[i:j]).lower() for i, j in zip(s, e, strict=True)]
    assert found == text.encode().lower().split()
    for x, w in zip(h, found, strict=True):
        assert x == hashing.word_hashes(np.frombuffer(b"pad " + w, np.uint8))[1]


def test_pieces_do_not_change_words(monkeypatch):
    b = np.frombuffer(("some words " * 50 + "x" * 300).encode(), np.uint8)
    whole = hashing.word_hashes(b)
    monkeypatch.setattr(hashing, "PIECE", 7)
    assert (hashing.word_hashes(b) == whole).all()
