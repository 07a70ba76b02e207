"""Media columns: content-addressed payloads in tar shards.

A payload (bytes, padded with zeros to a positive multiple of 64) is stored losslessly as
the samples of an 8-bit greyscale PNG image of width 64. Images are members of tar shards,
named by the SHA-256 of their payload; equal payloads have one address. Rows carry the
digest, shard, offset and length of their member. Metadata columns are filled from the
image header alone, by a range read of its first bytes; features from a range read of the
whole member.

Scale: payloads are never shuffled. Each task writes its own shards, a payload once; the
index then has one member a digest, so that all rows with equal payloads share it. Members
that other tasks wrote of it are not referred to: ``compact`` writes shards of which they are
more than ``DEAD`` anew without them, and removes the old ones. A shard is written by one task under a name of
its own attempt; only shards named in the index that was written count, so lost or
repeated tasks do no harm. Shards live in the shared folder and are reached by
``pyarrow.fs``, never by local paths.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.tables import table
from kinfold.session import fresh_path, materialize

WIDTH = 64
LEVEL = 6
SHARD_BYTES = 256 << 20
#: Share of a shard's bytes that no row refers to, from which it is written anew.
DEAD = 0.25
#: Bytes of a PNG image up to the end of its header chunk.
HEADER = 33
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload(text: Column) -> Column:
    """The text's UTF-8 bytes (null: none) and zeros up to a positive multiple of 64."""
    data = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    size = F.octet_length(data)
    pad = F.when(size == 0, WIDTH).otherwise(F.pmod(-size, F.lit(WIDTH)))
    return F.concat(data, F.substring(F.lit(bytes(WIDTH)), F.lit(1), pad))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(data: bytes) -> bytes:
    """A greyscale image whose samples, row by row, are ``data`` (a positive multiple of 64 bytes)."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)  # filter type 0 before each row
    lines[:, 1:] = rows
    header = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int, int]:
    """``(width, height, bit depth, colour type)`` from the first bytes of an image."""
    if data[:8] != _SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not a PNG image")
    return struct.unpack(">IIBB", data[16:26])


def decode_png(data: bytes) -> bytes:
    """The samples of an image that ``encode_png`` made."""
    width, height, _, _ = png_header(data)
    at, packed = 8, []
    while at < len(data):
        (size,) = struct.unpack(">I", data[at : at + 4])
        if data[at + 4 : at + 8] == b"IDAT":
            packed.append(data[at + 8 : at + 8 + size])
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("unexpected row filter")
    return lines[:, 1:].tobytes()


def feature(data: bytes) -> str:
    """Rows, mean sample, entropy in bits and number of distinct samples."""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = counts[counts > 0] / len(data)
    return f"rows={len(data) // WIDTH};mean={counts @ np.arange(256) / len(data):.4f};entropy={-(share * np.log2(share)).sum():.4f};distinct={len(share)}"


class _Writer:
    """Tar shards of one task, under names of its own."""

    def __init__(self, folder: str, shard_bytes: int):
        self.fs, self.root = pyarrow.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.limit, self.out, self.shard, self.at = shard_bytes, None, "", 0

    def add(self, digest: str, image: bytes) -> tuple[str, str, int, int]:
        """Append a member: ``(digest, shard, offset, length)``."""
        if self.out is None:
            self.shard, self.at = f"{uuid.uuid4().hex}.tar", 0
            self.out = self.fs.open_output_stream(f"{self.root}/{self.shard}")
        info = tarfile.TarInfo(f"{digest}.png")
        info.size = len(image)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        self.out.write(head + image + bytes(-len(image) % 512))
        row = (digest, self.shard, self.at + len(head), len(image))
        self.at += len(head) + len(image) + -len(image) % 512
        if self.at >= self.limit:
            self.close()
        return row

    def close(self) -> None:
        if self.out is not None:
            self.out.write(bytes(1024))
            self.out.close()
            self.out = None


_MEMBERS = "digest string, shard string, offset long, length long"


def _members(rows: list[tuple[str, str, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["digest", "shard", "offset", "length"])


def store(payloads: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the distinct ``payload`` values to shards in ``folder``: ``(digest, shard, offset, length)``.

    Payloads are not null. Repeated ones are one member. An empty table writes no shard.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(folder, shard_bytes)
        seen: set[bytes] = set()
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    rows = []
                    for data in batch.column(0).slice(start, 512).to_pylist():
                        key = hashlib.sha256(data).digest()
                        if key not in seen:
                            seen.add(key)
                            rows.append(out.add(key.hex(), encode_png(data)))
                    yield _members(rows)
        finally:
            out.close()

    members = materialize(payloads.select("payload").mapInArrow(write, _MEMBERS), "members")
    place = F.min(F.struct("shard", "offset", "length")).alias("at")
    index = materialize(members.groupBy("digest").agg(place).select("digest", "at.*").sortWithinPartitions("shard", "offset"), "index")
    return compact(index, members, folder, shard_bytes)


def compact(index: DataFrame, members: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, dead: float = DEAD) -> DataFrame:
    """``index`` after shards that hold too much else are written anew.

    ``members`` has all that the shards hold. The old shards are removed once the new index
    is written; a task that is repeated finds them gone, which is what it wants.
    """
    whole = members.groupBy("shard").agg(F.sum("length").alias("all"))
    live = index.groupBy("shard").agg(F.sum("length").alias("live"))
    old = whole.join(live, "shard", "left").where(F.coalesce("live", F.lit(0)) < (1 - dead) * F.col("all")).select("shard")
    old = materialize(old, "old")
    if old.isEmpty():
        return index

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, out = _Shards(folder), _Writer(folder, shard_bytes)
        try:
            for batch in batches:
                yield _members([out.add(d, shards.read(s, o, n)) for d, s, o, n in zip(*[c.to_pylist() for c in batch.columns], strict=True)])
        finally:
            out.close()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                if fs.get_file_info(f"{root}/{shard}").type == pyarrow.fs.FileType.File:
                    fs.delete_file(f"{root}/{shard}")
            yield batch

    moved = index.join(old, "shard", "left_semi").select("digest", "shard", "offset", "length").repartition("shard").sortWithinPartitions("shard", "offset")
    moved = materialize(moved.mapInArrow(copy, _MEMBERS), "moved")
    fresh = materialize(index.join(old, "shard", "left_anti").select(*moved.columns).unionByName(moved).sortWithinPartitions("shard", "offset"), "index")
    old.mapInArrow(remove, "shard string").count()
    return fresh


class _Shards:
    """Range reads, keeping the last shard open."""

    def __init__(self, folder: str):
        self.fs, self.root = pyarrow.fs.FileSystem.from_uri(folder)
        self.name, self.file = None, None

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if shard != self.name:
            self.name, self.file = shard, self.fs.open_input_file(f"{self.root}/{shard}")
        return self.file.read_at(length, offset)


def probe(index: DataFrame, folder: str) -> DataFrame:
    """Add ``width, height, bit_depth, color_type`` to an index, reading ``HEADER`` bytes a member.

    A member that is no PNG image is an error; an empty index gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(folder)
        for batch in batches:
            got = [png_header(shards.read(s, o, HEADER)) for s, o in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            extra = [pa.array([g[k] for g in got], pa.int32()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "width", "height", "bit_depth", "color_type"])

    return index.select("digest", "shard", "offset", "length").mapInArrow(run, "digest string, shard string, offset long, length long, width int, height int, bit_depth int, color_type int")


def features(index: DataFrame, folder: str) -> DataFrame:
    """Add what the stored bytes give: digests of payload and image, the tail's checksum, a feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(folder)
        for batch in batches:
            rows = []
            for digest, shard, offset, length in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                image = shards.read(shard, offset, length)
                data = decode_png(image)
                rows.append((digest, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-WIDTH:]), len(image), hashlib.sha256(image).hexdigest(), feature(data)))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return index.select("digest", "shard", "offset", "length").mapInArrow(run, "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Store every text; ``(id_col, n_bytes, digest, shard, offset, length, width, ..., feature)`` a row.

    Null texts count as empty; an empty text is a payload of 64 zeros. Equal texts share one
    member and get equal values. Repeated rows give repeated rows; an empty table stores
    nothing. ``folder`` is a new folder in the shared one unless given; it stays.
    """
    folder = folder or fresh_path(docs.sparkSession, "media", keep=True)  # rows point to it
    text = F.col(text_col)
    index = store(docs.select(payload(text).alias("payload")), folder)
    known = materialize(probe(index, folder).join(features(index, folder), "digest"), "members")
    rows = docs.select(F.col(id_col), F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_bytes"), F.sha2(payload(text), 256).alias("digest"))
    # A text that many rows have is a hot key of the left side only: adaptive execution splits it.
    return rows.join(known, "digest")


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media_columns(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "bit_depth", "digest", "shard", "offset", "length")
