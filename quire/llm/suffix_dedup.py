"""Repeated-string removal with deep-shallow suffix sorting.

A byte goes if a LENGTH-byte string over it also starts in a document of smaller id.

1. Candidate search. Each LENGTH-byte window is named by its anchor, the least-hashed GRAM-byte string
   in it, so equal windows have equal anchors wherever they are. Anchors that occur in two or more
   documents are shared; windows of the others are unique. About one position in SPAN / 2 is an anchor.
2. The context of a shared anchor is the text that its windows span. A document that holds a
   context after another one (by id) loses all windows of it: the inside of a shared passage.
3. What is left are contexts in the first document to hold them whose anchor has other contexts as
   well: the edges of passages. One copy of each such context is sorted: its windows are suffixes, sorted
   by `deep_shallow`; suffixes with LENGTH bytes in common are one class, and all but the class's smallest
   document lose that window, wherever it has the context. An anchor with more than PART contexts is dealt
   to parts; the windows that are first in their part meet in an aggregation of their hashes.

Hot anchors, contexts and passages: aggregations combine before the shuffle, joins are plain sort-merge
joins that Spark splits, and no group over PART contexts is ever in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import GRAM, LENGTH, Prefix, anchors
from .common import LAST_ID, Workspace, shuffle_partitions

#: Contexts of one anchor that are sorted together at most.
PART = 2_048
#: Depth to which multikey quicksort goes before blind tries take over.
SHALLOW = 32
#: Contexts whose suffixes are sorted at once.
BLOCK = 8_000
#: Bytes of texts that are hashed at once; a longer text is hashed alone.
CHUNK = 1 << 17


# --- deep-shallow sorting ---------------------------------------------------------------------


def words_of(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a big-endian number; bytes past the end are 0."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    w = np.zeros(len(data), np.uint64)
    for k in range(8):
        w = (w << np.uint64(8)) | padded[k : k + len(data)]
    return w


def multikey_quicksort(words: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): starts sorted by their first `depth` bytes (a multiple of 8), equal ones in one group.

    Keys are the 8-byte words. Each pass quicksorts by the next key within the groups that all earlier keys
    left equal, all groups at once; groups of one are settled and leave the work.
    """
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    live = np.arange(len(starts))  # places in order
    for d in range(0, depth, 8):
        if not len(live):
            break
        w = words[starts[order[live]] + d]
        by = np.lexsort((w, group[live])) if d else np.argsort(w, kind="stable")
        order[live], w, g = order[live][by], w[by], group[live]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])])
        group[live] = live[np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))]
        single = new & np.concatenate([new[1:], [True]])
        live = live[~single]
    return order, group


class BlindTrie:
    """A Patricia trie that keeps only branching depths and bytes: a string is placed by one descent and one comparison."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root: list | bytes | None = None

    def add(self, s: bytes) -> None:
        """Adds s; all strings have one length."""
        if self.root is None:
            self.root = s
            return
        node = self.root
        while isinstance(node, list):  # the blind descent: unseen bytes may differ
            depth, edges = node
            node = edges.get(s[depth]) or next(iter(edges.values()))
        if node == s:
            return
        depth = next(k for k, (a, b) in enumerate(zip(s, node, strict=True)) if a != b)
        other = node[depth]
        parent, key, node = None, None, self.root
        while isinstance(node, list) and node[0] < depth:
            parent, key, node = node, s[node[0]], node[1][s[node[0]]]
        if isinstance(node, list) and node[0] == depth:
            node[1][s[depth]] = s
            return
        new = [depth, {other: node, s[depth]: s}]
        if parent is None:
            self.root = new
        else:
            parent[1][key] = new

    def ordered(self) -> list[bytes]:
        out, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def deep_shallow(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, same): the suffixes at starts sorted by their first `length` bytes, and for each place in order
    the place of the first suffix with the same ones. Each start has length bytes."""
    words = words_of(data)
    order, group = multikey_quicksort(words, starts, shallow)
    same = group.copy()
    raw = data.tobytes()
    edge = np.flatnonzero(np.diff(group, prepend=-1, append=-2))
    sizes = np.diff(edge)
    # Groups whose members agree with their first to the full length need no trie.
    many = np.flatnonzero(sizes[np.searchsorted(edge, group)] > 1)
    mixed = np.zeros(len(order) + 1, bool)
    for depth in [*range(shallow, length - 8, 8), length - 8]:
        differs = words[starts[order[many]] + depth] != words[starts[order[group[many]]] + depth]
        mixed[group[many[differs]]] = True
    use = mixed[edge[:-1]]
    for at, n in zip(edge[:-1][use].tolist(), sizes[use].tolist(), strict=True):
        members = order[at : at + n].tolist()
        leaves: dict[bytes, list[int]] = {}
        for m, s in zip(members, starts[order[at : at + n]].tolist(), strict=True):
            leaves.setdefault(raw[s + shallow : s + length], []).append(m)
        trie = BlindTrie()
        for rest in leaves:
            trie.add(rest)
        place = at
        for rest in trie.ordered():
            equal = leaves[rest]
            order[place : place + len(equal)] = equal
            same[place : place + len(equal)] = place
            place += len(equal)
    return order, same


# --- stages ----------------------------------------------------------------------------------


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(low, high, bytes, ends): the batch's texts low to high, one after another, with where each ends."""
    column = batch["data"]
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1)
        yield low, high, raw[offsets[low] : offsets[high]], offsets[low + 1 : high + 1] - offsets[low]
        low = high


def _batch(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    """Columns of a schema string; numbers take their types from it."""
    fields = [x.split() for x in names.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    arrays = [c if isinstance(c, pa.Array) else pa.array((c.view(np.int64) if c.dtype == np.uint64 else c), kinds[t]) for (_, t), c in zip(fields, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])


GRAMS = "gram long, id long"
PLACES = "gram long, id long, row long, place long"


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """GRAMS: the anchors of each text."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for low, high, data, ends in _chunks(batch):
                at, _, _, grams = anchors(data, ends)
                if len(at):
                    yield _batch(GRAMS, grams, batch["id"].to_numpy()[low:high][np.searchsorted(ends, at, "right")])


def _place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """PLACES: the anchors with where they are: position in the text, windows before it (5 bits), windows (6 bits)."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for low, high, data, ends in _chunks(batch):
                at, first, last, grams = anchors(data, ends)
                if len(at):
                    of = np.searchsorted(ends, at, "right")
                    start = np.concatenate([[0], ends[:-1]])[of]
                    place = (at - start) << 11 | (at - first) << 6 | (last - first + 1)
                    yield _batch(PLACES, grams, *(batch[c].to_numpy()[low:high][of] for c in ("id", "row")), place)


CONTEXTS = "gram long, k1 long, id long, row long, first int, n int"


def _lists(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """(offsets, values) of a list column, the first offset 0."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], column.values.slice(offsets[0], offsets[-1] - offsets[0])


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CONTEXTS at the shared places: a hash of the context beside that of its anchor, its first window and number of windows."""
    with np.errstate(over="ignore"):
        for batch in batches:
            counts, places = _lists(batch["places"])
            places = places.to_numpy()
            for low, high, data, ends in _chunks(batch):
                mine = places[counts[low] : counts[high]]
                of = np.repeat(np.arange(high - low), np.diff(counts[low : high + 1]))
                start = np.concatenate([[0], ends[:-1]])[of]
                at, before, n = start + (mine >> 11), (mine >> 6) & 31, mine & 63
                first = at - before
                p = Prefix(data)
                # The key takes in where the anchor is in the context.
                yield _batch(CONTEXTS, p.hashes(at, at + GRAM), p.hashes(first, first + n - 1 + LENGTH, before + 1), *(batch[c].to_numpy()[low:high][of] for c in ("id", "row")), first - start, n)


EDGES = "gram long, k1 long, part int, parts int, id long, n int, bytes binary"


def _edge_rows(part: int):
    """EDGES: the bytes that an edge context's windows span. An anchor's contexts are dealt to parts of about `part`."""

    def edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, edges = _lists(batch["edges"])
            ids = np.repeat(batch["id"].to_numpy(), np.diff(counts))
            gram, k1, contexts, first, n = (edges.field(k).to_numpy() for k in range(5))
            parts = -(-contexts // part)
            end = first + n - 1 + LENGTH
            for low in range(0, batch.num_rows, 500):
                high = min(low + 500, batch.num_rows)
                cut = slice(counts[low], counts[high])
                raw = [data[a:b] for d, data in enumerate(batch["data"].slice(low, 500).to_pylist(), low) for a, b in zip(first[counts[d] : counts[d + 1]].tolist(), end[counts[d] : counts[d + 1]].tolist(), strict=True)]
                yield _batch(EDGES, gram[cut], k1[cut], k1[cut] % parts[cut], parts[cut], ids[cut], n[cut], pa.array(raw, pa.binary()))

    return edge_rows


SORTED = "gram long, k1 long, id long, step int, n int, h1 long, h2 long"


def _sort_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of edge contexts in order of (gram, part): runs of windows to remove (h1 null), and of anchors with several
    parts the windows that are first in theirs, with hashes of their bytes."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def blocks() -> Iterator[pa.Table]:
        nonlocal rows
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= BLOCK:
                t = pa.Table.from_batches(held)
                g, p = t["gram"].to_numpy(), t["part"].to_numpy()
                cut = np.flatnonzero((g != g[-1]) | (p != p[-1]))
                if len(cut):  # the last group may go on
                    n = int(cut[-1]) + 1
                    yield t.slice(0, n)
                    held[:] = t.slice(n).to_batches()
                    rows = t.num_rows - n
        if rows:
            yield pa.Table.from_batches(held)

    with np.errstate(over="ignore"):
        for t in blocks():
            for lo, hi in _group_cuts(t, BLOCK):
                yield from _sort_block(t.slice(lo, hi - lo))


def _group_cuts(t: pa.Table, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of about `most` rows that split no group."""
    g, p = t["gram"].to_numpy(), t["part"].to_numpy()
    ends = [*(np.flatnonzero((g[1:] != g[:-1]) | (p[1:] != p[:-1])) + 1).tolist(), len(g)]
    lo = 0
    for e, after in zip(ends, [*ends[1:], None], strict=True):
        if after is None or after - lo > most:
            yield lo, e
            lo = e


def _sort_block(t: pa.Table) -> Iterator[pa.RecordBatch]:
    texts = t["bytes"].to_pylist()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = t["n"].to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    starts = (np.cumsum(sizes) - sizes)[owner] + step
    order, same = deep_shallow(data, starts)
    gram, k1, ids, parts = (t[c].to_numpy() for c in ("gram", "k1", "id", "parts"))
    sorted_ids = ids[owner[order]]
    heads = np.flatnonzero(same == np.arange(len(same)))
    least = np.minimum.reduceat(sorted_ids, heads)[np.searchsorted(heads, same)]
    gone = np.zeros(len(owner), bool)
    gone[order] = sorted_ids > least
    # Runs of windows of one context.
    run = np.flatnonzero(gone & ~(np.concatenate([[False], gone[:-1]]) & np.concatenate([[False], owner[1:] == owner[:-1]])))
    end = np.flatnonzero(gone & ~(np.concatenate([gone[1:], [False]]) & np.concatenate([owner[1:] == owner[:-1], [False]]))) + 1
    if len(run):
        o, none = owner[run], pa.nulls(len(run), pa.int64())
        yield _batch(SORTED, gram[o], k1[o], ids[o], step[run], end - run, none, none)
    if len(open_ := np.flatnonzero(~gone & (parts[owner] > 1))):
        o, s = owner[open_], starts[open_]
        # Hashes of the window's bytes forwards and backwards.
        yield _batch(SORTED, gram[o], k1[o], ids[o], step[open_], np.ones(len(o), np.int64), Prefix(data).hashes(s, s + LENGTH), Prefix(data[::-1]).hashes(len(data) - s - LENGTH, len(data) - s))


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def cut(data: bytes, runs: np.ndarray) -> tuple[bytes, int, int]:
    """(data without the bytes of the runs' windows, bytes removed, maximal runs removed); a run is first window * 64 + number."""
    if not len(runs):
        return data, 0, 0
    runs = np.sort(runs)
    first, end = runs >> 6, (runs >> 6) + (runs & 63) - 1 + LENGTH
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    starts, ends = first[new].tolist(), reach[np.concatenate([new[1:] - 1, [len(runs) - 1]])].tolist()
    kept = b"".join([data[a:b] for a, b in zip([0, *ends], [*starts, len(data)], strict=True)])
    return kept, len(data) - len(kept), len(starts)


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in KEPT.split(", ")]
    for batch in batches:
        counts, runs = _lists(batch["runs"])
        runs = runs.to_numpy()
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            out = []
            for k, data in enumerate(part["data"].to_pylist(), lo):
                kept, removed, spans = cut(data, runs[counts[k] : counts[k + 1]])
                out.append((len(data), removed, spans, kept))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (*[pa.int64()] * 3, pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([part["doc_id"], *columns], names)


def repeated_runs(ws: Workspace, rows: DataFrame, part: int) -> DataFrame:
    """(id, row, run): runs of windows that a document of smaller id holds, as cut takes them. rows: id, row, data."""
    n = shuffle_partitions(ws.spark)
    grams = rows.select("id", "data").mapInArrow(_gram_rows, GRAMS).groupBy("gram").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    shared = ws.write(grams.where("lo < hi").select("gram"), "grams")
    found = rows.mapInArrow(_place_rows, PLACES).join(shared, "gram")
    places = ws.write(found.groupBy("id", "row").agg(F.collect_set("place").alias("places")), "places")
    ws.done(shared)
    contexts = ws.write(rows.join(places, ["id", "row"]).mapInArrow(_context_rows, CONTEXTS), "contexts")
    ws.done(places)
    key = ["gram", "k1"]  # 128 bits together
    first = ws.write(contexts.groupBy(*key).agg(F.min("id").alias("lo")), "first")
    several = first.groupBy("gram").agg(F.count("*").alias("contexts")).where("contexts > 1")
    known = first.join(several, "gram", "left")
    # Later holders of a context lose its windows; its first holder's are sorted where the anchor has other contexts.
    edge = F.col("id") == F.col("lo")
    held = contexts.join(known, key).where("id > lo or contexts > 1")
    held = ws.write(held.select("id", "row", "first", "n", *[F.when(edge, F.col(c)).alias(c) for c in (*key, "contexts")]), "held")
    ws.done(contexts, first)
    run = lambda first, n: (F.col(first).cast("long") * 64 + F.col(n)).alias("run")
    inside = held.where("contexts is null").select("id", "row", run("first", "n"))
    edges = held.where("contexts is not null")
    # One copy of each context: its first document may hold it often.
    one = edges.groupBy(*key).agg(F.min(F.struct("id", "row", "contexts", "first", "n")).alias("x")).select(*key, "x.*")
    listed = one.groupBy("id", "row").agg(F.collect_list(F.struct(*key, "contexts", "first", "n")).alias("edges"))
    dealt = rows.join(listed, ["id", "row"]).mapInArrow(_edge_rows(part), EDGES).repartition(n, "gram", "part").sortWithinPartitions("gram", "part")
    dealt = ws.write(dealt.mapInArrow(_sort_edges, SORTED), "sorted")
    met = dealt.where("h1 is not null")
    least = met.groupBy("h1", "h2").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    late = met.join(least.select("h1", "h2", "lo"), ["h1", "h2"]).where("id > lo")
    gone = dealt.where("h1 is null").select(*key, "step", "n").unionByName(late.select(*key, "step", "n"))
    outer = edges.select(*key, "id", "row", "first").join(gone, key).select("id", "row", (F.col("first") + F.col("step")).alias("first"), "n")
    gathered = inside.unionByName(outer.select("id", "row", run("first", "n"))).groupBy("id", "row").agg(F.collect_set("run").alias("runs"))
    out = ws.write(gathered, "runs")
    ws.done(held, dealt)
    return out


def remove_repeats(spark: SparkSession, docs: DataFrame, *, part: int = PART) -> DataFrame:
    """Per row of docs (doc_id, text; others are ignored): doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    Null text: empty. Texts under LENGTH bytes lose nothing. Repeated rows: rows with equal doc_id are one
    document and don't remove each other. A null doc_id counts as the largest. An empty table gives an empty
    result. Very long texts are handled whole, row by row. Ties don't arise: the smallest id keeps.
    """
    ws = Workspace(spark)
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(data).alias("row"), data.alias("data"))
    runs = repeated_runs(ws, rows.select("id", "row", "data"), part)
    none = F.array().cast("array<long>")
    found = rows.join(runs, ["id", "row"], "left").select(F.col("doc_id").cast("long").alias("doc_id"), "data", F.coalesce("runs", none).alias("runs"))
    return found.mapInArrow(_cut_rows, KEPT)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
