"""Media columns: payloads by content in tar shards; rows carry digest, shard, offset and length.

A task packs what it reads into one shard at a time: each distinct payload once, as a 64-sample-wide
8-bit greyscale PNG named by the payload's SHA-256. Rows get the address; of the addresses that tasks
gave to one digest, the smallest stands, so equal payloads have one address. Payloads never move
through a shuffle. Metadata columns come from range reads of the PNG header alone; features from a
range read of the whole member, in the order of the shard.

Shards go to the shared folder, under names that no other attempt of a task takes, and the index is
a written table: an attempt that is lost leaves an unused file, never a wrong address.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace

UNIT = 64
#: Signature, IHDR's length and type, and its 13 bytes.
HEADER_BYTES = 29
PNG = b"\x89PNG\r\n\x1a\n"
#: A shard is closed when it has so many bytes.
SHARD_BYTES = 256 << 20

INDEX = "doc_id long, n_bytes long, digest string, payload_bytes long, shard string, offset long, length long"
HEADERS = "digest string, width int, height int, bit_depth int, color_type int"
FEATURES = "digest string, width int, height int, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def payload_of(data: bytes) -> bytes:
    """data with bytes 0 up to a positive multiple of UNIT."""
    return data + bytes(max(UNIT, -(-len(data) // UNIT) * UNIT) - len(data))


def encode(payload: bytes) -> bytes:
    """The payload as PNG: rows of UNIT samples, filter 0."""
    rows = len(payload) // UNIT
    lines = np.zeros((rows, UNIT + 1), np.uint8)
    lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, UNIT)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", UNIT, rows, 8, 0, 0, 0, 0)
    return PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def header(data: bytes) -> tuple[int, int, int, int]:
    """Width, height, bit depth and colour type from a PNG's first HEADER_BYTES."""
    if data[:8] != PNG or data[12:16] != b"IHDR":
        raise ValueError("not a PNG")
    return struct.unpack(">IIBB", data[16:26])


def decode(data: bytes) -> bytes:
    width, height, _, _ = header(data)
    at, body = 8, []
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IDAT":
            body.append(data[at + 8 : at + 8 + n])
        at += n + 12
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    return lines[:, 1:].tobytes()


def feature(samples: bytes) -> str:
    """Size, mean, deviation and the signs of 16 bands against the mean."""
    x = np.frombuffer(samples, np.uint8)
    mean = int(x.sum(dtype=np.int64)) / len(x)
    squares = int((x.astype(np.int64) ** 2).sum()) / len(x)
    bands = "".join("1" if b.mean() > mean else "0" for b in np.array_split(x, 16))
    return f"g8:{UNIT}x{len(x) // UNIT}:{mean:.3f}:{max(squares - mean * mean, 0) ** 0.5:.3f}:{int(bands, 2):04x}"


class Shard:
    """A tar file that grows at its end."""

    def __init__(self, root: str):
        from pyarrow import fs

        self.uri = f"{root}/{uuid.uuid4().hex}.tar"
        self.fs, path = fs.FileSystem.from_uri(self.uri if ":" in self.uri else f"file://{self.uri}")
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.at = self.fs.open_output_stream(path), 0

    def add(self, name: str, data: bytes) -> int:
        """The offset of data."""
        info = tarfile.TarInfo(name)
        info.size = len(data)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        start = self.at + len(head)
        for part in (head, data, bytes(-len(data) % 512)):
            self.out.write(part)
            self.at += len(part)
        return start

    def close(self) -> None:
        self.out.write(bytes(1024))
        self.out.close()


def _writer(root: str, shard_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, placed = None, {}
        for batch in batches:
            out = []
            for doc_id, data in zip(batch["doc_id"].to_pylist(), batch["data"], strict=True):
                data = data.as_py()
                payload = payload_of(data)
                digest = hashlib.sha256(payload).hexdigest()
                if digest not in placed:
                    if shard is None or shard.at >= shard_bytes:
                        if shard:
                            shard.close()
                        shard, placed = Shard(root), {}
                    media = encode(payload)
                    placed[digest] = (shard.uri, shard.add(f"{digest}.png", media), len(media))
                out.append((doc_id, len(data), digest, len(payload), *placed[digest]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                    ["doc_id", "n_bytes", "digest", "payload_bytes", "shard", "offset", "length"],
                )
        if shard:
            shard.close()

    return write


def store(spark: SparkSession, docs: DataFrame, ws: Workspace, *, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index: a written table of INDEX, each row's digest and address; null text counts as empty."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"))
    return ws.write(rows.mapInArrow(_writer(f"{ws.root}/shards", shard_bytes), INDEX), "index")


def addresses(index: DataFrame) -> DataFrame:
    """One address per digest: digest, shard, offset, length."""
    best = index.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at"))
    return best.select("digest", "at.*")


def _ranges(pdf: pd.DataFrame):
    """(row, read(n)) for each address, shard by shard."""
    from pyarrow import fs

    for uri, rows in pdf.groupby("shard", sort=False):
        system, path = fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")
        with system.open_input_file(path) as f:
            for r in rows.sort_values("offset").itertuples(index=False):
                yield r, lambda n, f=f, r=r: f.read_at(min(n, r.length), r.offset)


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame([(r.digest, *header(read(HEADER_BYTES))) for r, read in _ranges(pdf)], columns=["digest", "width", "height", "bit_depth", "color_type"])


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for r, read in _ranges(pdf):
            width, height, _, _ = header(read(HEADER_BYTES))
            media = read(r.length)
            samples = decode(media)
            digest = hashlib.sha256(samples).hexdigest()
            if digest != r.digest:
                raise ValueError(f"{r.shard} at {r.offset}: not the payload {r.digest}")
            out.append((r.digest, width, height, digest, zlib.crc32(samples[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples)))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in FEATURES.split(", ")])


def _by_shard(spark: SparkSession, at: DataFrame) -> DataFrame:
    """Addresses in the shards' order; a shard's size bounds what one task gets of it."""
    return at.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard").sortWithinPartitions("shard", "offset")


def metadata(spark: SparkSession, index: DataFrame) -> DataFrame:
    """HEADERS of each digest, from header-only range reads."""
    return _by_shard(spark, addresses(index)).mapInPandas(_headers, HEADERS)


def features(spark: SparkSession, index: DataFrame) -> DataFrame:
    """FEATURES of each digest, from the stored bytes."""
    return _by_shard(spark, addresses(index)).mapInPandas(_features, FEATURES)


def media_columns(spark: SparkSession, docs: DataFrame, *, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row of docs (doc_id, text; others are ignored): its index entry and FEATURES.

    Null text: empty, a payload of UNIT zeros. Very long texts are one member. Equal payloads share an
    address; repeated rows stay rows. An empty table gives an empty result and no shard.
    """
    ws = Workspace(spark)
    index = store(spark, docs, ws, shard_bytes=shard_bytes)
    found = ws.write(features(spark, index), "features")
    return index.join(found, "digest")


def read_member(uri: str, name: str) -> bytes:
    """A member by name, with tarfile: shards are ordinary tar files."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")
    with system.open_input_file(path) as f, tarfile.open(fileobj=io.BytesIO(f.read())) as t:
        return t.extractfile(name).read()


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media_columns(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height")
