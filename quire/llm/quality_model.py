"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector over hashed text for all grades, and
ordered thresholds. x marks which hashed words and style marks a text has. The sample of rated documents
is bounded; its features are taken where the texts are and counted by groupBy, and only what each text has of
the chosen ones meets in the one task that fits. Every document of the table is then scored whole, in
numpy over Arrow batches. A score is the expected grade and the probability of the top grade.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace
from .shingles import _BASE, _BYTE, _LOWER, _SPACE, _UNBASE, _powers, mix

#: Rated documents that fitting uses at most: those whose hashed doc_id is least, so a sample that only the ids decide.
SAMPLE = 8_000
#: Words are hashed to so many bits: a long text then meets no feature by chance.
BITS = 40
#: Hashed features with weights, at most: of those in so many of the sample's documents, the ones whose frequency in a
#: grade differs most from that in all, if by so many standard deviations of one document: an effect, whatever the sample's size.
FEATURES, LEAST_DOCS, LEAST_EFFECT = 1_024, 8, 0.4
GRADES = 3
STEPS, RATE, PENALTY = 400, 0.05, 1e-3
#: A document is selected from this probability of the top grade on.
TAIL = 0.5
#: Bytes featurized at once.
CHUNK = 1 << 19

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
#: Marks counted per word: symbols, bars, exclamation marks.
_MARKS = [np.isin(np.arange(256), list(b)) for b in (b"#*$%&<>@^~=+\\{}[]", b"|", b"!?")]
#: Style marks are features 0 to STYLE - 1: bins of each rate.
BINS = np.array([0.02, 0.1, 0.3, 0.6, 0.9])
STYLE = (len(_MARKS) + 3) * len(BINS)


def _segments(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(mask, prepend=False, append=False))
    return edge[::2], edge[1::2]


def _hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_BYTE[low] * _powers(_BASE, len(low)), dtype=np.uint64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_UNBASE, len(low))[starts] + (ends - starts).astype(np.uint64))


def _group(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    low = _LOWER[data]
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    with np.errstate(over="ignore"):
        ws, we = _segments(_LETTER[data])  # letters only: marks at a word don't change it
        hashed = (_hashes(low, ws, we) >> np.uint64(64 - BITS)).astype(np.int64)
        ts, te = _segments(~_SPACE[data])
        token = _hashes(low, ts, te)
    hashed = np.maximum(hashed, STYLE)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    marks = [np.concatenate([[0], np.cumsum(m[data])]) for m in _MARKS]
    same = np.concatenate([[0], np.cumsum(np.concatenate([[False], token[1:] == token[:-1]]))]) if len(token) else np.zeros(1, np.int64)
    out = []
    wc, tc = np.searchsorted(ws, bounds), np.searchsorted(ts, bounds)
    for k in range(len(texts)):
        a, b, n = bounds[k], bounds[k + 1], tc[k + 1] - tc[k]
        words = np.unique(hashed[wc[k] : wc[k + 1]])
        if n:
            distinct = len(np.unique(token[tc[k] : tc[k + 1]]))
            rates = [*[(m[b] - m[a]) / n for m in marks], (upper[b] - upper[a]) / max(letters[b] - letters[a], 1), (same[tc[k + 1]] - same[tc[k]]) / n, max(0.0, 1 - distinct / n - 0.3)]
            style = [i * len(BINS) + j for i, r in enumerate(rates) for j in range(int(np.searchsorted(BINS, r, "right")))]
        else:
            style = []
        out.append(np.concatenate([np.array(style, np.int64), words]))
    return out


def features(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The hashed features that each UTF-8 text has."""
    group: list[bytes] = []
    size = 0
    for t in texts:
        if group and size + len(t) > CHUNK:
            yield from _group(group)
            group, size = [], 0
        group.append(t)
        size += len(t) + 1
    if group:
        yield from _group(group)


def fit(owner: np.ndarray, found: np.ndarray, ids: np.ndarray, grades: np.ndarray, *, grades_n: int = GRADES) -> tuple[np.ndarray, np.ndarray]:
    """(weights of ids, thresholds): penalized maximum likelihood by Adam, a fixed number of full steps.

    Row `owner` of grades has feature `found`, for each pair of them; ids are sorted.
    """
    n = len(grades)
    share = np.array([max((grades == g).sum(), 1) for g in range(grades_n)])
    at = np.minimum(np.searchsorted(ids, found), max(len(ids) - 1, 0))
    keep = ids[at] == found if len(ids) else np.zeros(len(found), bool)
    r, c = owner[keep], at[keep]
    weight = (n / (grades_n * share))[grades] if n else np.zeros(0)  # grades count alike
    w, gaps = np.zeros(len(ids)), np.concatenate([[-1.0], np.zeros(grades_n - 2)])  # thresholds: gaps[0], then + exp(gaps[k])
    m1, m2 = np.zeros(len(ids) + len(gaps)), np.zeros(len(ids) + len(gaps))
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, STEPS + 1 if n else 1):
        t = np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))
        z = np.bincount(r, w[c], n)
        upper = np.where(grades < grades_n - 1, sig(t[np.minimum(grades, grades_n - 2)] - z), 1.0)
        lower = np.where(grades > 0, sig(t[np.maximum(grades - 1, 0)] - z), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) * weight / p, lower * (1 - lower) * weight / p
        dz = (du - dl) / n  # of the loss
        gw = np.bincount(c, dz[r], len(ids)) + PENALTY * w
        gt = np.zeros(grades_n - 1)
        np.add.at(gt, np.minimum(grades, grades_n - 2), np.where(grades < grades_n - 1, -du, 0) / n)
        np.add.at(gt, np.maximum(grades - 1, 0), np.where(grades > 0, dl, 0) / n)
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([gw, tail[:1], tail[1:] * np.exp(gaps[1:])])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w, gaps = w - move[: len(ids)], gaps - move[len(ids) :]
    return w, np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))


RATED = "doc_id long, row long, grade int, least array<long>, found array<long>"


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """RATED: the features of rated texts; least: the three least hashed words, which most near copies have in common."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            found = list(features(part["data"].to_pylist()))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in ([f[f >= STYLE][:3] for f in found], found)]
            yield pa.RecordBatch.from_arrays([*(part[c] for c in ("doc_id", "row", "grade")), *lists], [x.split()[0] for x in RATED.split(", ")])


MODEL = "weights array<double>, thresholds array<double>"


def _fitter(ids: np.ndarray):
    def fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "row", "grade"])  # the order of arrival doesn't matter
        owner = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf["found"]])
        w, t = fit(owner, np.concatenate(pdf["found"].tolist()).astype(np.int64), ids, pdf["grade"].to_numpy())
        return pd.DataFrame({"weights": [w.tolist()], "thresholds": [t.tolist()]})

    return fit_group


def chosen(rows: DataFrame) -> np.ndarray:
    """The ids of the features of rows (RATED) that get weights, sorted: at most FEATURES of them.

    Near copies of one grade count once, else the words of one text that was copied would look telling.
    """
    once = rows.groupBy("least", "grade").agg(F.min(F.struct("doc_id", "row")).alias("x")).select("grade", "x.*")
    once = rows.join(once, ["grade", "doc_id", "row"], "left_semi")
    sizes = {r["grade"]: r["count"] for r in once.groupBy("grade").count().collect()}
    total = max(sum(sizes.values()), 1)
    has = lambda g: F.sum((F.col("grade") == g).cast("int"))
    counts = once.select("grade", F.explode(F.array_distinct("found")).alias("id")).groupBy("id").agg(F.count("*").alias("docs"), *[has(g).alias(f"n{g}") for g in range(GRADES)])
    overall = F.col("docs") / total
    effects = [F.abs((F.col(f"n{g}") + 0.5) / (sizes.get(g, 0) + 1) - overall) / F.sqrt(overall * (1 - overall) + 1e-6) for g in range(GRADES)]
    effect = counts.where(F.col("docs") >= LEAST_DOCS).select("id", F.greatest(*effects).alias("effect")).where(F.col("effect") >= LEAST_EFFECT)
    best = effect.orderBy(F.desc("effect"), "id").limit(FEATURES)
    return np.sort(np.array([r["id"] for r in best.collect()], np.int64))


def train(spark: SparkSession, docs: DataFrame, rated: DataFrame, *, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, sorted, their weights, thresholds) from at most `sample` of the rated (doc_id, grade) with their texts.

    Null grades don't count; equal texts of one doc_id and grade count once.
    """
    ws = Workspace(spark)
    some = rated.where("doc_id is not null and grade is not null").select("doc_id", "grade").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)
    data = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text").cast("binary").alias("data"))
    rows = data.join(F.broadcast(some), "doc_id").select("doc_id", "row", "grade", "data").mapInArrow(_featurize, RATED).dropDuplicates(["doc_id", "row", "grade"])
    rows = ws.write(rows.orderBy(F.xxhash64("doc_id", "row"), "doc_id", "row", "grade").limit(sample), "rated")
    ids = chosen(rows)
    keep = F.array(*[F.lit(int(i)) for i in ids]) if len(ids) else F.array().cast("array<long>")
    narrow = rows.select("doc_id", "row", "grade", F.array_intersect("found", keep).alias("found"))
    found = narrow.groupBy(F.lit(0).alias("all")).applyInPandas(_fitter(ids), MODEL).collect()
    ws.done(rows)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0), np.array([0.0] * (GRADES - 1))
    return ids, np.array(found[0]["weights"]), np.array(found[0]["thresholds"])


SCORES = "doc_id long, expected_grade double, tail_probability double"


def linear(found: np.ndarray, ids: np.ndarray, weights: np.ndarray) -> float:
    """The weights of a text's features, summed; ids are sorted."""
    if not len(ids) or not len(found):
        return 0.0
    at = np.minimum(np.searchsorted(ids, found), len(ids) - 1)
    return float(weights[at[ids[at] == found]].sum())


def _scorer(ids: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                z = np.array([linear(f, ids, weights) for f in features(part["data"].to_pylist())])
                above = 1 - 1 / (1 + np.exp(-np.clip(thresholds[None, :] - z[:, None], -40, 40)))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(above.sum(axis=1)), pa.array(above[:, -1])], [x.split()[0] for x in SCORES.split(", ")])

    return score


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """SCORES of each row of docs; the model has at most FEATURES weights."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select(F.col("doc_id").cast("long"), data.alias("data")).mapInArrow(_scorer(*model), SCORES)


def graded(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 toxic, 1 of low quality, 2 good; null where a rating is missing."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.cast("int").alias("grade"))


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, tail: float = TAIL) -> DataFrame:
    """Per row of docs (doc_id, text; others are ignored): doc_id, expected_grade (0 to 2), tail_probability (of grade 2), kept.

    Null and empty texts have no features: their score is the thresholds' own. Labels without a rating, or of
    no document, don't count; a document rated twice counts twice. Without any label all texts score alike.
    Repeated rows are each scored; an empty table gives an empty result; very long texts are read whole.
    """
    Workspace(spark)
    found = score(docs, train(spark, docs, graded(labels), sample=sample))
    return found.withColumn("kept", F.col("tail_probability") >= tail)


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
