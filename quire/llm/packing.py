"""Packing by shortest-pack-first over the length histogram.

1. Documents are tokenized once, in Arrow batches, and cut into pieces: whole sequences, then a rest.
   A piece's row carries its checksum, so no token moves again.
2. Lengths are counted: at most `size` counts, whatever the corpus.
3. The driver packs the histogram: lengths from the longest down, each into the shortest open
   packs that it fits, whole groups of equal packs at a time, so the patterns are few.
4. Patterns go back to pieces by rank: the pieces of one length, in order of doc_id, fill the
   slots of that length. Ranks come from a range sort by (length, doc_id, start) and the counts of its
   partitions, so a length that a third of the pieces share is spread over many tasks.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, shuffle_partitions

SIZE = 2048
EOS = 1

#: Up to so many slots or ranges (under 100 bytes each) are broadcast; beyond, a join shuffles.
BROADCAST_ROWS = 200_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file, whose ids are in the order of its merges."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"] for t in model.get("added_tokens", [])}
    return {bytes(byte[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}


class ByteTokenizer:
    """Ids of a text as little-endian 32-bit bytes: those of `tokenizers` with the byte-level vocabulary at path.

    tiktoken merges the same vocabulary several times as fast; a text that holds the string of an added
    token, which has an id of its own, is left to `tokenizers`.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = re.compile("|".join(re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()) or r"(?!)")
        self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_ranks(path), special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        found = array("I", self.whole.encode(text, add_special_tokens=False).ids if self.added.search(text) else self.encode(text))
        if sys.byteorder != "little":
            found.byteswap()
        return found.tobytes()


#: One for each worker process and vocabulary.
_TOKENIZERS: dict[str, ByteTokenizer] = {}


def tokenizer_of(path: str) -> ByteTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ByteTokenizer(path)
    return _TOKENIZERS[path]


def _cutter(path: str, size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer_of(path).ids
        end = struct.pack("<I", EOS)
        names = [x.split()[0] for x in PIECES.split(", ")]
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = ids_of(text.as_py()) + end
                n = len(ids) // 4
                out += [(doc_id, s, min(size, n - s), zlib.crc32(ids[4 * s : 4 * (s + size)]), n) for s in range(0, n, size)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    return cut


def pieces(docs: DataFrame, *, path: str | None = None, size: int = SIZE) -> DataFrame:
    """PIECES: whole sequences of each document's ids (with EOS at their end), then the rest."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_cutter(path or vocabulary(), size), PIECES)


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """(count, lengths) of the packing patterns of histogram (length: count).

    Lengths go longest first into the shortest open packs with room; equal packs are one group, and a
    group is split only when the pieces of a length run out, so a length adds two groups at most.
    """
    open_packs: list[tuple[int, int, int, tuple]] = []  # a heap of (used, number, count, pattern)
    done: list[tuple[int, tuple]] = []
    number = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_packs and open_packs[0][0] + length <= size:
                used, _, count, pattern = heapq.heappop(open_packs)
                take = min(left, count)
                if take < count:
                    number += 1
                    heapq.heappush(open_packs, (used, number, count - take, pattern))
            else:
                used, take, pattern = 0, left, None
                fit = size // length
                if fit > 1 and left >= fit:  # as many packs as leave none with room for another of this length
                    full = left // fit
                    chain = None
                    for _ in range(fit):
                        chain = (length, chain)
                    left -= full * fit
                    number += 1
                    _push(open_packs, done, (fit * length, number, full, chain), size)
                    continue
                take = 1 if fit > 1 else left
            left -= take
            number += 1
            _push(open_packs, done, (used + length, number, take, (length, pattern)), size)
    done += [(count, pattern) for _, _, count, pattern in sorted(open_packs)]
    out = []
    for count, pattern in done:
        lengths = []
        while pattern:
            lengths.append(pattern[0])
            pattern = pattern[1]
        out.append((count, lengths[::-1]))
    return out


def _push(open_packs: list, done: list, pack: tuple, size: int) -> None:
    if pack[0] == size:
        done.append((pack[2], pack[3]))
    else:
        heapq.heappush(open_packs, pack)


def slots(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, low, high, sequence, offset): pieces of that length with low <= rank < high go to sequence + rank - low, at offset."""
    out, ranks, sequence = [], {}, 0
    for count, lengths in patterns:
        at = 0
        for length in lengths:
            low = ranks.get(length, 0)
            out.append((length, low, low + count, sequence, at))
            ranks[length] = low + count
            at += length
        sequence += count
    return out


def pack(spark: SparkSession, rows: DataFrame, ws: Workspace, *, size: int = SIZE) -> DataFrame:
    """rows (with doc_id, start, length and more) with sequence_id and offset."""
    n = shuffle_partitions(spark)
    ordered = rows.repartitionByRange(n, "length", "doc_id", "start").sortWithinPartitions("length", "doc_id", "start")
    # The row's place in the sorted table, kept in a written one: the partition and the position there.
    placed = ws.write(ordered.withColumn("at", F.monotonically_increasing_id()), "sorted").withColumn("part", F.shiftright("at", 33))
    # Partitions are ranges of length: partitions plus lengths bound these rows.
    found = placed.groupBy("part", "length").agg(F.count("*").alias("n"), F.min("at").alias("first")).collect()
    histogram: dict[int, int] = {}
    starts = []
    for r in sorted(found, key=lambda r: (r["length"], r["part"])):
        starts.append((r["part"], r["length"], histogram.get(r["length"], 0) - r["first"]))
        histogram[r["length"]] = histogram.get(r["length"], 0) + r["n"]
    table = slots(shortest_pack_first(histogram, size))
    shift = spark.createDataFrame(starts, "part long, length long, shift long")
    where = spark.createDataFrame(table, "slot_length long, low long, high long, sequence long, slot_offset long")
    sent = lambda df, rows: F.broadcast(df) if len(rows) <= BROADCAST_ROWS else df
    ranked = placed.join(sent(shift, starts), ["part", "length"]).withColumn("rank", F.col("at") + F.col("shift"))
    fits = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    return ranked.join(sent(where, table), fits).select(
        *[F.col(c) for c in rows.columns], (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), F.col("slot_offset").alias("offset")
    )


def pack_documents(spark: SparkSession, docs: DataFrame, *, path: str | None = None, size: int = SIZE) -> DataFrame:
    """PIECES of docs (doc_id, text; others are ignored) with sequence_id and offset.

    A sequence's pieces follow one another without a gap from 0. Null or empty text: EOS alone. Very long
    texts give many whole sequences. Repeated rows are packed each. Ties of length go by doc_id and
    start. An empty table gives an empty result.
    """
    ws = Workspace(spark)
    cut = ws.write(pieces(docs, path=path, size=size), "pieces")
    packed = pack(spark, cut, ws, size=size)
    ws.done(cut)
    return packed


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
