"""Near-duplicate documents by MinHash.

1. One pass hashes each text's 5-word shingles and takes HASHES universal hash minima. Documents with
   equal sets are one class from here on, stood for by the smallest doc_id.
2. BANDS bands of ROWS minima are bucketed. A bucket's members are paired with its smallest member
   alone: a star, linear in the bucket.
3. Pairs whose signatures agree too little are dropped (the least agreement is six standard deviations
   below what a similarity of 0.75 gives), the rest confirmed on the full sets.
4. Confirmed pairs are joined to components by large-star and small-star.
5. In buckets that then still hold several components, every two members of different ones are paired.
   A bucket is cut into blocks: components that fill some have blocks of their own, the others share
   blocks. Two blocks meet in a task, but for two of one component, so rows are members times blocks and
   pairs are compared where they lie: by bitmaps with a bit per shingle. Each bit that differs stands for
   a shingle that only one set has, so a pair with more of them than 0.75 allows is no link, for certain.
   The others go through 3's confirmation and join components.

So every two texts that share a band are in one component or were compared; no bucket is too large, and
nothing is sampled. At 0.75, all bands miss a pair with probability (1 - 0.75 ** ROWS) ** BANDS = 5e-6;
what 3 drops by signatures, 5 compares again. The work of 5 grows with the pairs of a bucket's members in
different components, not with those of a group of copies, which are one component by then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST_ID, Workspace, shuffle_partitions
from .components import components
from .shingles import mix, shingle_sets, similar

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
PERCENT = 75
#: Least number of agreeing minima: 96 are expected at 0.75, with a standard deviation of 4.9.
AGREE = int(HASHES * 0.75 - 6 * (HASHES * 0.75 * 0.25) ** 0.5)

#: Members of a block; a bucket that would have more than MOST_BLOCKS has larger ones.
BLOCK, MOST_BLOCKS = 512, 64
#: Bits of a bitmap for each shingle, at least; a power of two of bits in all, from the least to the most. The most make
#: the comparison of very long texts less sharp: more pairs are confirmed, none is lost.
PER_SHINGLE, LEAST_BITS, MOST_BITS = 8, 2**9, 2**17
#: So many of the largest ids stand for null ones.
NULLS = 2**40

_rng = np.random.Generator(np.random.PCG64(77))
_A = _rng.integers(1, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, np.uint64)

SIGNED = "id long, row long, n_shingles long, c1 long, c2 long, sig binary"


def signature(s: np.ndarray) -> np.ndarray:
    """Minima of HASHES multiply-shift hashes of a set."""
    best = np.full(HASHES, 2**32 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 2048):
            h = s[at : at + 2048, None] * _A
            h += _B
            h >>= np.uint64(32)
            np.minimum(best, h.min(axis=0), out=best)
    return best.astype("<u4")


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            sizes, keys, signs = [], [], []
            for s in shingle_sets(part["data"].to_pylist()):
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_intdigest(s.tobytes()))
                signs.append(signature(s).tobytes() if len(s) else None)
            halves = np.array([(k >> 64, k & (2**64 - 1)) for k in keys], np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part["id"], part["row"], pa.array(sizes, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(signs, pa.binary())],
                [x.split()[0] for x in SIGNED.split(", ")],
            )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch["sig"].to_pylist()), "<u4").reshape(-1, BANDS, ROWS).astype(np.uint64)
        with np.errstate(over="ignore"):
            h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), sig.shape[:2])
            for k in range(ROWS):
                h = mix(h * np.uint64(0xD1B54A32D192ED03) + sig[:, :, k])
        yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(np.repeat(batch["id"].to_numpy(), BANDS))], ["bucket", "id"])


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u4").reshape(-1, HASHES) for c in ("su", "sv"))
        yield batch.select(["u", "v"]).filter(pa.array((x == y).sum(axis=1) >= AGREE))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = {t for c in ("tu", "tv") for t in part[c].to_pylist()}  # a star's centre once
            sets = dict(zip(texts, shingle_sets(list(texts)), strict=True))
            yield part.select(["u", "v"]).filter(pa.array([similar(sets[a], sets[b], PERCENT) for a, b in zip(part["tu"].to_pylist(), part["tv"].to_pylist(), strict=True)], pa.bool_()))


def _bitmap(s: np.ndarray) -> bytes:
    """A bit for each shingle of a set, by the lowest bits of its hash."""
    n = min(max(1 << (PER_SHINGLE * len(s) - 1).bit_length(), LEAST_BITS), MOST_BITS)
    bits = np.zeros(n, bool)
    bits[s & np.uint64(n - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sizes, maps = [], []
            for s in shingle_sets(part["data"].to_pylist()):
                sizes.append(len(s))
                maps.append(_bitmap(s))
            yield pa.RecordBatch.from_arrays([part["id"], pa.array(sizes, pa.int64()), pa.array(maps, pa.binary())], ["id", "size", "map"])


def _close(of: np.ndarray, size: np.ndarray, maps: list[bytes], left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y) of left and right in different components, unless their bitmaps show that they aren't similar enough."""
    width = np.array([len(m) for m in maps])
    # Of two similar sets one is at most 4/3 of the other: its bitmap is as wide, or twice as wide and is folded.
    for w in np.unique(width).tolist():
        narrow, wide = width == w, width == 2 * w
        whole, folded = (np.frombuffer(b"".join(maps[i] for i in np.flatnonzero(m)), np.uint64) for m in (narrow, wide))
        flat = np.concatenate([whole.reshape(-1, w // 8), np.bitwise_or.reduce(folded.reshape(-1, 2, w // 8), axis=1)])
        row = np.zeros(len(maps), np.int64)
        row[np.concatenate([np.flatnonzero(narrow), np.flatnonzero(wide)])] = np.arange(len(flat))
        some, others = left[(narrow | wide)[left]], right[(narrow | wide)[right]]
        for at in range(0, len(some), 32):
            x, y = some[at : at + 32, None], others[None]
            fit = 100 * np.minimum(size[x], size[y]) >= PERCENT * np.maximum(size[x], size[y])
            i, j = np.nonzero(fit & (of[x] != of[y]) & (narrow[x] | narrow[y]))
            i, j = x[i, 0], y[0, j]
            step = max(1, 2**19 // w)
            for k in range(0, len(i), step):
                x, y = i[k : k + step], j[k : k + step]
                differ = np.bitwise_count(flat[row[x]] ^ flat[row[y]]).sum(axis=1, dtype=np.int64)
                # With D shingles in one set only, of S in both together, the similarity is (S - D) / (S + D).
                keep = (100 + PERCENT) * differ <= (100 - PERCENT) * (size[x] + size[y])
                yield x[keep], y[keep]


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v), u > v, of the members of a meeting on sides 0 and 1, or both on side 2, that _close gives; a meeting's rows lie together."""
    held = None

    def met(meeting: pa.Table) -> Iterator[pa.RecordBatch]:
        side, ids, of, size = (meeting[c].to_numpy() for c in ("side", "id", "component", "size"))
        maps = meeting["map"].to_pylist()
        at = [np.flatnonzero(side == k) for k in range(3)]
        for left, right in ((at[0], at[1]), (at[2], at[2])):
            if len(left) and len(right):
                for x, y in _close(of, size, maps, left, right):
                    if len(x):
                        yield pa.RecordBatch.from_arrays([pa.array(np.maximum(ids[x], ids[y])), pa.array(np.minimum(ids[x], ids[y]))], ["u", "v"])

    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        meeting = held["meeting"].to_numpy()
        cuts = [0, *(np.flatnonzero(meeting[1:] != meeting[:-1]) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield from met(held.slice(a, b - a))
        held = held.slice(cuts[-1])  # may go on
    if held is not None:
        yield from met(held)


class Graph:
    """The links between classes of documents with equal shingle sets."""

    def __init__(self, spark: SparkSession, docs: DataFrame):
        self.spark, self.ws = spark, Workspace(spark)
        data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
        self.rows = docs.select(_id(data).alias("id"), F.xxhash64(data).alias("row"), data.alias("data"))
        self.signed = self.ws.write(self.rows.mapInArrow(_sign, SIGNED), "signed")
        full = self.signed.where("n_shingles > 0")
        # One row per set: its smallest document stands for it.
        self.classes = self.ws.write(full.groupBy("c1", "c2").agg(F.min(F.struct("id", "row", "sig")).alias("x")).select("c1", "c2", "x.*"), "classes")
        self.sigs = self.classes.select("id", "sig")
        self.bands = self._shared(self.sigs)
        # The texts of all that may be linked, moved once.
        wanted = self.classes.select("id", "row").join(self.bands.select("id").distinct(), "id", "left_semi")
        self.texts = self.ws.write(self.rows.join(wanted, ["id", "row"], "left_semi").dropDuplicates(["id", "row"]).select("id", "data"), "texts")

    def _shared(self, nodes: DataFrame) -> DataFrame:
        """(bucket, id, lead) of the buckets with several members."""
        bands = self.ws.write(nodes.mapInArrow(_bands, "bucket long, id long"), "all-bands")
        leads = bands.groupBy("bucket").agg(F.min("id").alias("lead"), F.max("id").alias("most")).where("lead < most").select("bucket", "lead")
        shared = self.ws.write(bands.join(leads, "bucket"), "bands")
        self.ws.done(bands)
        return shared

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The (u, v) of pairs that are similar enough."""
        with_u = pairs.join(self.texts.withColumnsRenamed({"id": "u", "data": "tu"}), "u")
        both = with_u.join(self.texts.withColumnsRenamed({"id": "v", "data": "tv"}), "v").select("u", "v", "tu", "tv")
        return self.ws.write(both.mapInArrow(_confirm, "u long, v long").distinct(), "links")

    def _stars(self) -> DataFrame:
        """(u, v): the members of each bucket with its least, if they agree."""
        stars = self.bands.where("id != lead").select(F.col("id").alias("u"), F.col("lead").alias("v")).distinct()
        sig = lambda a, b: self.sigs.withColumnsRenamed({"id": a, "sig": b})
        pairs = stars.join(sig("u", "su"), "u").join(sig("v", "sv"), "v").select("u", "v", "su", "sv")
        return self.ws.write(pairs.mapInArrow(_agree, "u long, v long"), "stars-agreeing")

    def _torn(self, label: DataFrame) -> DataFrame:
        """(bucket, id, component, block) of the members of buckets with several components. label: (id, component) where it isn't id."""
        member = self.ws.write(_labelled(self.bands.select("bucket", "id"), label), "members")
        sizes = member.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        torn = sizes.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.sum("n").alias("m")).where("a < b")
        parts = sizes.join(torn.select("bucket", F.greatest(F.lit(BLOCK), F.ceil(F.col("m") / MOST_BLOCKS)).alias("size")), "bucket")
        parts = self.ws.write(parts.withColumn("own", F.col("n") >= F.col("size")), "parts")
        small = parts.where("not own").groupBy("bucket").agg(F.sum("n").alias("small"))
        parts = parts.join(small, "bucket", "left")
        # A component that fills blocks has its own, by id; the others are dealt whole.
        cells = F.ceil(F.when(F.col("own"), F.col("n")).otherwise(F.col("small")) / F.col("size"))
        key = F.when(F.col("own"), F.xxhash64("id")).otherwise(F.xxhash64("component"))
        block = F.struct("own", F.when(F.col("own"), F.col("component")).otherwise(0).alias("of"), F.pmod(key, "cells").alias("cell"))
        dealt = member.join(parts.select("bucket", "component", "own", cells.alias("cells")), ["bucket", "component"])
        return self.ws.write(dealt.select("bucket", "id", "component", block.alias("block")), "torn")

    def _rest(self, torn: DataFrame) -> DataFrame:
        """(u, v): all members of one bucket that are in different components, but for those that can't be similar enough."""
        ws, n = self.ws, shuffle_partitions(self.spark)
        texts = self.texts.join(torn.select("id").distinct(), "id", "left_semi")
        maps = ws.write(texts.mapInArrow(_mapped, "id long, size long, map binary"), "maps")
        blocks = ws.write(torn.select("bucket", "block").distinct(), "blocks")
        met = blocks.withColumnRenamed("block", "x").join(blocks.withColumnRenamed("block", "y"), "bucket")
        met = met.where("x <= y and not (x.own and y.own and x.of = y.of)").withColumn("meeting", F.xxhash64("bucket", "x", "y"))
        sides = F.when(F.col("x") == F.col("y"), F.array(F.struct(F.lit(2).alias("side"), F.col("x").alias("block"))))
        sides = sides.otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("block")), F.struct(F.lit(1).alias("side"), F.col("y").alias("block"))))
        seats = met.select("bucket", "meeting", F.inline(sides))
        placed = torn.join(seats, ["bucket", "block"]).select("meeting", "side", "id", "component").join(maps, "id")
        together = placed.repartition(n, "meeting").sortWithinPartitions("meeting")
        return together.mapInArrow(_crossed, "u long, v long").distinct()

    def _joined(self, label: DataFrame, links: DataFrame) -> DataFrame:
        """label after links joined components: only the components that links touch are a graph again."""
        ends = _labelled(links.select(F.col("u").alias("id"), "v"), label).select(F.col("component").alias("u"), F.col("v").alias("id"))
        c = components(self.ws, _labelled(ends, label).select("u", F.col("component").alias("v")))
        moved = label.join(c.withColumnRenamed("u", "component"), "component", "left").select("id", F.coalesce("v", "component").alias("component"))
        # A component's least node has no label of its own.
        return self.ws.write(moved.unionByName(_named(c)), "labels-joined")

    def labels(self) -> DataFrame:
        """(c1, c2, component) of each class: the least id that links reach."""
        ws = self.ws
        tried = self._stars()
        label = _named(components(ws, self.confirmed(tried)))
        fresh = ws.write(self._rest(self._torn(label)).join(tried, ["u", "v"], "left_anti"), "pairs")
        more = self.confirmed(fresh)
        if more.limit(1).count():
            label = self._joined(label, more)
        return ws.write(_labelled(self.classes.select("c1", "c2", "id"), label).select("c1", "c2", "component"), "labels")


def _id(data: Column) -> Column:
    """doc_id; a null one is a number among the NULLS largest, by the text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID) - F.pmod(F.xxhash64(data), F.lit(NULLS)))


def _named(links: DataFrame) -> DataFrame:
    return links.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _labelled(nodes: DataFrame, label: DataFrame) -> DataFrame:
    """nodes with component: that of label, or the id itself."""
    return nodes.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text; others are ignored): doc_id, n_shingles, component_id, kept.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; fewer than 5 words are
    one shingle. Null, empty and blank texts have no shingles and are linked with nothing. Repeated rows
    are each returned; rows with equal doc_id are one node. Rows without a doc_id count as larger than all
    others and are one document per text; where they are the least of a component, its id is null. An empty
    table gives an empty result. Very long texts are hashed in full.
    """
    g = Graph(spark, docs)
    labels = g.labels()
    g.ws.keep_only(g.signed, labels)
    found = g.signed.select("id", "n_shingles", "c1", "c2").join(labels, ["c1", "c2"], "left")
    own = lambda c: F.when(F.col(c) <= LAST_ID - NULLS, F.col(c))
    found = found.withColumn("component", F.coalesce("component", "id"))
    return found.select(own("id").alias("doc_id"), "n_shingles", own("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs with all their columns that near_duplicates keeps; of rows with equal doc_id and text, each."""
    g = Graph(spark, docs)
    found = g.signed.select("id", "row", "c1", "c2").join(g.labels(), ["c1", "c2"], "left")
    gone = g.ws.write(found.where("id != component").select("id", "row").distinct(), "gone")
    g.ws.keep_only(gone)
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    keys = docs.select(_id(data).alias("id"), F.xxhash64(data).alias("row"), F.struct(*[F.col(c) for c in docs.columns]).alias("whole"))
    return keys.join(gone, ["id", "row"], "left_anti").select("whole.*")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
