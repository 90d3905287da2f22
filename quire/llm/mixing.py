"""Mixing sources to target weights by iterative proportional fitting.

Tokens (words) are summed per cell of source, language and topic. Raking scales the tokens to keep in the cells
until their marginals meet the targets, and never keeps more of a cell than it has: what a full cell can't give,
the others of its marginals make up in the next steps. A cell's kept tokens over its own are the probability with
which its documents are kept. The total to keep is the budget, or less where a marginal doesn't have its target's
share of that. A document's draw is a hash of its id, so a sample is the same wherever and whenever it is made.

Targets that aren't given are each marginal's own shares, tempered, which lifts the small ones, but by no more
than a sample of the budget's size can: a rare topic is kept whole, not made the measure of all others.

Topics come from spherical k-means over the hashed words of all documents. Each document's vector is written
once, in whole numbers; a round sums vectors by nearest centre where they are read and merges the sums by
groupBy. Products and sums of whole numbers are exact, so the centres don't depend on how rows are dealt.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST_ID, Workspace
from .shingles import _words

AXES = ("source", "lang", "topic")
KEYS = ["doc_id", "source", "lang", "row"]
TOPICS = 8
#: Words are hashed to so many sums, whose vector is scaled to length UNIT and rounded.
WIDTH, UNIT = 1_024, 32_767
#: Rounds of k-means at most; it ends when the centres stay.
ROUNDS = 12
#: Targets that aren't given: each marginal's own shares to this power, which lifts the small ones.
TEMPER = 0.7
#: Share of all tokens to keep, at most.
BUDGET = 0.8
SEED = 20_240_611
#: Raking: rounds at most, the error of a marginal's share at which it ends, and the one that is told of.
RAKES, CLOSE, MISSED = 50, 1e-6, 1e-3
#: Up to so many cells (under 200 bytes each) are raked on the driver and broadcast; beyond, raking and the join are distributed.
LOCAL_CELLS = 100_000


# --- topics ----------------------------------------------------------------------------------


def word_sums(text: bytes) -> tuple[np.ndarray, int]:
    """(unit vector of signed hashed word counts, damped; number of words)."""
    data = np.frombuffer(text + b" ", np.uint8)
    with np.errstate(over="ignore"):
        _, words = _words(data)
    ids, n = np.unique(words, return_counts=True)
    sums = np.bincount((ids >> np.uint64(32)).astype(np.int64) % WIDTH, np.sqrt(n) * (1 - 2 * (ids & np.uint64(1)).astype(np.int64)), WIDTH)
    size = np.linalg.norm(sums)
    return (sums / size if size else sums), len(words)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sums = [word_sums(t) for t in part["_data"].to_pylist()]
            vectors = [np.rint(v * UNIT).astype("<i2").tobytes() for v, _ in sums]
            yield pa.RecordBatch.from_arrays([*[part[c] for c in KEYS], pa.array([n for _, n in sums], pa.int64()), pa.array(vectors, pa.binary())], [*KEYS, "tokens", "vector"])


def vectors(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, row, tokens and vector of each row; null source, language and text count as ''."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("source", "lang")], F.xxhash64(data).alias("row"), data.alias("_data"))
    return rows.mapInArrow(_vectors, "doc_id long, source string, lang string, row long, tokens long, vector binary")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of the batches and their vectors. Doubles hold the products and sums of these whole numbers exactly."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            yield part, np.frombuffer(b"".join(part["vector"].to_pylist()), "<i2").reshape(-1, WIDTH).astype(float)


def _race(centres: np.ndarray):
    """Of each partition the row that is the first in a race: chances are as the distances from the centres so far."""

    def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for part, v in _parts(batches):
            far = 1 - (v @ centres.T).max(axis=1) / UNIT**2 if len(centres) else np.ones(len(v))
            lot = part["lot"].to_numpy(zero_copy_only=False)
            time = np.where(far > 1e-3, -np.log1p(-lot) / np.maximum(far, 1e-3), np.inf)  # rounding keeps copies of a centre within 1e-3
            k = int(np.lexsort((part["row"].to_numpy(zero_copy_only=False), time))[0])
            own = (float(time[k]), part["row"][k].as_py(), part["vector"][k].as_py())
            best = own if best is None else min(best, own)
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in best], ["time", "row", "vector"])

    return race


def _sums(centres: np.ndarray):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(centres.shape)
        for _, v in _parts(batches):
            total += np.eye(len(centres))[(v @ centres.T).argmax(axis=1)].T @ v
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(total.ravel()[slots].astype(np.int64))], ["slot", "total"])

    return sums


def fit_topics(vectors: DataFrame, *, topics: int = TOPICS, rounds: int = ROUNDS) -> np.ndarray:
    """Topic centres of all vectors with tokens: rows of length UNIT, fewer than `topics` if fewer texts differ."""
    some = vectors.where("tokens > 0")
    centres = np.zeros((0, WIDTH))
    for k in range(topics):
        lots = some.select("row", "vector", (F.shiftrightunsigned(F.xxhash64(F.lit(SEED + 1 + k), "doc_id", "row"), 11) / F.lit(float(2**53))).alias("lot"))
        first = lots.mapInArrow(_race(centres), "time double, row long, vector binary").agg(F.min(F.struct("time", "row", "vector")).alias("x")).first()["x"]
        if first is None or first["time"] == float("inf"):
            break
        centres = np.vstack([centres, np.frombuffer(first["vector"], "<i2").astype(float)])
    for _ in range(rounds if len(centres) else 0):
        total = np.zeros(centres.size)
        for slot, x in some.select("vector").mapInArrow(_sums(centres), "slot int, total long").groupBy("slot").agg(F.sum("total")).collect():
            total[slot] = x
        total = total.reshape(centres.shape)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        new = np.where(size > 0, np.rint(total / np.maximum(size, 1) * UNIT), centres)
        if (new == centres).all():
            break
        centres = new
    return centres


def _assign(centres: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, v in _parts(batches):
            topic = (v @ centres.T).argmax(axis=1) if len(centres) else np.zeros(len(v))
            yield pa.RecordBatch.from_arrays([*[part[c] for c in KEYS], pa.array(topic.astype(np.int32)), part["tokens"]], [*KEYS, "topic", "tokens"])

    return assign


def measured(ws: Workspace, docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, row, topic and tokens of each row, written; null source, language and text count as ''."""
    found = ws.write(vectors(docs), "vectors")
    out = ws.write(found.mapInArrow(_assign(fit_topics(found)), "doc_id long, source string, lang string, row long, topic int, tokens long"), "measured")
    ws.done(found)
    return out


# --- raking ----------------------------------------------------------------------------------


def tempered(shares: pd.Series, budget: float = BUDGET, power: float = TEMPER) -> pd.Series:
    """shares to a power, in proportion, none over 1 / budget times what it was."""
    most, lifted = shares / budget, shares**power
    full = pd.Series(False, shares.index)
    while True:
        rest = lifted.where(~full, 0.0)
        out = most.where(full, rest * ((1 - most[full].sum()) / rest.sum()) if rest.sum() > 0 else 0.0)
        over = ~full & (out > most * (1 + 1e-12))
        if not over.any():
            return out
        full |= over


def targets_of(shares: pd.Series, given: dict | None, budget: float) -> pd.Series:
    """The shares to reach of a marginal's values; given: of values to shares, those that aren't there left out."""
    if given is None:
        return tempered(shares, budget)
    want = pd.Series([float(given.get(v, 0.0)) for v in shares.index], shares.index)
    return want / want.sum() if want.sum() > 0 else shares


def to_keep(budget: float, marginals: list[tuple[pd.Series, pd.Series]]) -> float:
    """The share of all tokens to keep: the budget, or what the scarcest value of (shares, targets) allows."""
    return min([budget, *(float((have[want > 0] / want[want > 0]).min()) for have, want in marginals if (want > 0).any())])


def rake(cells: pd.DataFrame, targets: dict[str, dict], budget: float) -> pd.DataFrame:
    """cells (AXES, tokens > 0) with `weight`, whose sums by axis are the targets' shares, and `probability`, at most 1.

    targets: axis to value to share; an axis without targets is tempered. Values of a given axis without a share get none.
    """
    cells = cells.sort_values(list(AXES)).reset_index(drop=True)
    if not len(cells):
        return cells.assign(weight=0.0, probability=0.0)
    own = (cells["tokens"] / cells["tokens"].sum()).to_numpy(float)
    axes = []
    for a in AXES:
        codes, values = pd.factorize(cells[a], sort=True)
        have = pd.Series(np.bincount(codes, own, len(values)), values)
        axes.append((codes, have, targets_of(have, targets.get(a), budget)))
    total = to_keep(budget, [(have, want) for _, have, want in axes])
    kept = own * total
    for _ in range(RAKES):
        worst = 0.0
        for codes, _, want in axes:
            have, goal = np.bincount(codes, kept, len(want)), want.to_numpy() * total
            worst = max(worst, float(np.abs(have - goal).max()) / total)
            kept = np.minimum(own, kept * np.where(have > 0, goal / np.where(have > 0, have, 1), 0)[codes])
        if worst < CLOSE:
            break
    else:
        _warn(worst)
    return cells.assign(weight=kept / kept.sum(), probability=kept / own)


def _warn(worst: float) -> None:
    if worst > MISSED:
        warnings.warn(f"after {RAKES} rounds of raking a marginal misses its target by {worst:.3g}: no sample meets all of them", stacklevel=3)


def rake_distributed(ws: Workspace, cells: DataFrame, targets: dict[str, dict], budget: float) -> DataFrame:
    """What `rake` gives, for more cells than a driver should hold: marginals come to the driver, cells don't."""
    spark = ws.spark
    total_tokens = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    cells = cells.withColumn("own", F.col("tokens") / F.lit(total_tokens))
    marginals = {}
    for a in AXES:
        have = cells.groupBy(a).agg(F.sum("own").alias("have")).toPandas().set_index(a)["have"].sort_index()
        marginals[a] = have, targets_of(have, targets.get(a), budget)
    total = to_keep(budget, list(marginals.values()))
    wants = {a: spark.createDataFrame([(k, float(v) * total) for k, v in want.items()], cells.select(a, F.col("own").alias("goal")).schema) for a, (_, want) in marginals.items()}
    cells = ws.write(cells.withColumn("kept", F.col("own") * total), "cells")
    for _ in range(RAKES):
        worst = 0.0
        for a in AXES:
            scale = ws.write(cells.groupBy(a).agg(F.sum("kept").alias("have")).join(wants[a], a), "scale")
            worst = max(worst, (scale.agg(F.max(F.abs(F.col("have") - F.col("goal")))).first()[0] or 0.0) / total)
            factor = scale.select(a, F.when(F.col("have") > 0, F.col("goal") / F.col("have")).otherwise(0.0).alias("factor"))
            new = ws.write(cells.join(factor, a).withColumn("kept", F.least("own", F.col("kept") * F.col("factor"))).drop("factor"), "cells")
            ws.done(cells, scale)
            cells = new
        if worst < CLOSE:
            break
    else:
        _warn(worst)
    sum_ = float(cells.agg(F.sum("kept")).first()[0] or 1)
    return ws.write(cells.select(*AXES, (F.col("kept") / sum_).alias("weight"), (F.col("kept") / F.col("own")).alias("probability")), "probabilities")


def draw(*key: Column) -> Column:
    """A number in [0, 1) that only the key and SEED decide."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *key), 11) / F.lit(float(2**53))


def mix(spark: SparkSession, docs: DataFrame, *, targets: dict[str, dict] | None = None, budget: float = BUDGET, local_cells: int = LOCAL_CELLS) -> DataFrame:
    """Per row of docs (doc_id, text, source, lang; others are ignored): doc_id, source, lang, topic, tokens, weight
    (raked share of the row's cell), probability, draw, kept; and row, a hash of the text.

    Null source, language and text count as ''. Texts without words have no tokens: they belong to no cell's
    tokens and aren't kept. Rows with equal doc_id have equal draws. Draws below the probability keep. An empty
    table gives an empty result. Very long texts are read whole.
    """
    ws = Workspace(spark)
    targets = targets or {}
    m = measured(ws, docs)
    cells = ws.write(m.where("tokens > 0").groupBy(*AXES).agg(F.sum("tokens").alias("tokens")), "cells")
    if cells.limit(local_cells + 1).count() <= local_cells:
        found = rake(cells.toPandas(), targets, budget)
        rows = [(r.source, r.lang, int(r.topic), float(r.weight), float(r.probability)) for r in found.itertuples(index=False)]
        table = F.broadcast(spark.createDataFrame(rows, "source string, lang string, topic int, weight double, probability double"))
    else:
        table = rake_distributed(ws, cells, targets, budget)
    m = m.join(table, list(AXES), "left").withColumn("draw", draw(F.col("doc_id")))
    zero = lambda c: F.when(F.col("tokens") > 0, F.coalesce(c, F.lit(0.0))).otherwise(0.0).alias(c)
    m = m.select("doc_id", "row", *AXES, "tokens", zero("weight"), zero("probability"), "draw")
    return m.withColumn("kept", F.col("draw") < F.col("probability"))


def sample(spark: SparkSession, docs: DataFrame, *, targets: dict[str, dict] | None = None, budget: float = BUDGET) -> DataFrame:
    """The rows of docs with all their columns that mix keeps; the text and the probabilities meet by (doc_id, text)."""
    ws = Workspace(spark)
    kept = ws.write(mix(spark, docs, targets=targets, budget=budget).where("kept").select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "row").distinct(), "kept")
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    keys = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(data).alias("row"), F.struct(*[F.col(c) for c in docs.columns]).alias("whole"))
    return keys.join(kept, ["id", "row"], "left_semi").select("whole.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row")
