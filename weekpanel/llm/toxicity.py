"""Toxicity scores by FTRL-proximal logistic regression.

Features are the distinct word unigrams, bigrams and skip-grams (one word left
out) of a whole text, and unigrams of the words' stems (their first bytes, so
that unseen inflections share weights), hashed to 32 bits; words are runs of
letters, digits and non-ASCII bytes with A-Z folded. FTRL-proximal (McMahan et al., 2013) gives
every coordinate its own rate and L1 keeps few weights, so the model is a short
sorted table that is sent to every task.

The model is fitted on a bounded sample: the ``max_labelled`` labelled rows
with the smallest hash of doc_id. Everything else covers all rows."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekpanel.llm.hashing import NO_LETTER, U, mix, text_views, word_and_stem_hashes
from weekpanel.session import cut_lineage

MAX_LABELLED = 20_000  # the fit runs in one task over at most so many texts' features
EPOCHS = 10
ALPHA, BETA, L1, L2 = 3.0, 1.0, 5.0, 1.0
STEMS = (4, 5, 6)  # bytes
MIN_DOCS = 3  # features in fewer texts of the sample are left out
THRESHOLD = 0.7
_SALT = [U(0x8F1BBCDCBFA53E0B), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)]


def grams(b: np.ndarray) -> np.ndarray:
    """32-bit features of a text's bytes, repeats included."""
    w, *stems = word_and_stem_hashes(b, NO_LETTER, STEMS)
    found = [w, mix(w[:-1] * _SALT[0] + w[1:]), mix(w[:-2] * _SALT[1] + w[2:])]
    found += [mix(t * _SALT[2] + U(k)) for k, t in zip(STEMS, stems, strict=True)]
    return (np.concatenate(found) >> U(32)).astype(np.uint32)


def features(b: np.ndarray) -> np.ndarray:
    """Sorted distinct features."""
    return np.unique(grams(b))


def _featurize(batches):
    for batch in batches:
        found = [features(v).tobytes() for v in text_views(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("label"), pa.array(found, pa.binary())], ["k", "label", "f"])


def ftrl(examples: list, labels: np.ndarray, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA,
         l1: float = L1, l2: float = L2):
    """(bias, weights over the coordinates) for examples given as arrays of coordinates."""
    n_coords = max((int(x[-1]) + 1 for x in examples if len(x)), default=0)
    z, n = np.zeros(n_coords), np.zeros(n_coords)
    bz = bn = 0.0

    def weight(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for x, y in zip(examples, labels, strict=True):
            zx, nx = z[x], n[x]
            w = weight(zx, nx, l1)
            bw = float(weight(bz, bn, 0.0))
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, bw + w.sum())))) - y
            root = np.sqrt(nx)
            nx = nx + g * g
            z[x] = zx + g - (np.sqrt(nx) - root) / alpha * w
            n[x] = nx
            s = (math.sqrt(bn + g * g) - math.sqrt(bn)) / alpha
            bz, bn = bz + g - s * bw, bn + g * g
    return float(weight(bz, bn, 0.0)), weight(z, n, l1)


def _fit(min_docs: int, epochs: int):
    def run(batches):
        found, labels = [], []
        for batch in batches:
            found += [np.frombuffer(x, np.uint32) for x in batch.column("f").to_pylist()]
            labels += batch.column("label").to_pylist()
        if not found:
            return
        # features of one text are distinct, so runs in the sorted whole are document counts
        every = np.concatenate(found)
        every.sort()
        edge = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.zeros(0, int)
        vocabulary = every[edge][np.diff(np.append(edge, len(every))) >= min_docs]
        del every
        coords = [np.flatnonzero(np.isin(vocabulary, f, assume_unique=True)) if len(f) > len(vocabulary) else _coords(f, vocabulary) for f in found]
        bias, w = ftrl(coords, np.array(labels, float), epochs)
        used = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(vocabulary[used].astype(np.int64), -1)), pa.array(np.append(w[used], bias))], ["feature", "weight"])

    return run


def _coords(f: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return np.zeros(0, int)
    at = np.minimum(np.searchsorted(vocabulary, f), len(vocabulary) - 1)
    return at[vocabulary[at] == f]


def fit(docs: DataFrame, labelled: DataFrame, max_labelled: int = MAX_LABELLED, min_docs: int = MIN_DOCS, epochs: int = EPOCHS) -> dict:
    """{"bias", "features", "weights"} from docs (doc_id, text) and labelled (doc_id, label 0/1).

    Null labels and ids are ignored; a doc_id labelled twice takes the larger
    label; no labelled rows give a model that scores 0. A labelled doc_id in several rows counts once for
    each of its different texts; beyond ``max_labelled`` texts every doc_id keeps at least one. All weights that L1
    leaves are kept: at most the features that ``min_docs`` texts of the sample share."""
    k = F.xxhash64("doc_id")
    sample = labelled.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    sample = sample.orderBy(k, "doc_id").limit(max_labelled)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most max_labelled rows of two numbers
    rows = texts.select(k.alias("k"), "label", "text").mapInArrow(_featurize, "k long, label int, f binary")
    # a doc_id may stand in several rows: equal ones are one example, and every doc_id has a place before any has a second
    rows = cut_lineage(rows.distinct(), "examples")
    first = rows.groupBy("k").agg(F.min(F.xxhash64("f")).alias("d"))  # at most max_labelled rows of two numbers
    rows = rows.join(F.broadcast(first), "k").withColumn("later", F.xxhash64("f") != F.col("d"))
    rows = rows.orderBy("later", "k", "f").select("k", "label", "f").limit(max_labelled).coalesce(1).sortWithinPartitions("k", "f")
    fitted = rows.mapInArrow(_fit(min_docs, epochs), "feature long, weight double").toPandas()
    bias = fitted.weight[fitted.feature < 0]
    w = fitted[fitted.feature >= 0].sort_values("feature")
    return {"bias": float(bias.iloc[0]) if len(bias) else -math.inf, "features": w.feature.to_numpy(np.uint32), "weights": w.weight.to_numpy(float)}


def score_texts(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus score (0 to 1) and predicted (1 from ``threshold`` on); columns of these names are replaced.

    Null and empty texts score as texts without features: by the bias alone."""
    docs = docs.drop("score", "predicted")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # the weights of a sample of bounded size
    keep = docs.columns

    def run(batches):
        m = sent.value
        known = np.zeros(1 << 16, bool)
        known[m["features"] >> 16] = True
        for batch in batches:
            scores = []
            for v in text_views(batch.column("text")):
                total = m["bias"]
                f = grams(v)
                f = f[known[f >> 16]]
                if len(f):
                    total += m["weights"][_coords(np.unique(f), m["features"])].sum()
                scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, total)))) if total > -math.inf else 0.0)
            arrays = [batch.column(n) for n in keep] + [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "score", "predicted"])

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(run, schema)


def held_out(doc_id="doc_id"):
    """Column: the rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **parameters) -> DataFrame:
    """``docs`` plus score and predicted; learns from the ``toxic`` labels of rows that are not held out."""
    learnt = labels.where(~held_out()).select("doc_id", F.col("toxic").alias("label"))
    return score_texts(docs, fit(docs, learnt, **parameters), threshold)
