"""Media columns: content-addressed payloads in tar shards, with header-only range reads for metadata.

A payload (a text's UTF-8 bytes and bytes 255 up to a positive multiple of 576) is stored as an 8-bit grey PNG image 24
samples wide, a lossless form. Its name in the shard is the SHA-256 of the stored form; within a shard each content is
stored once, whatever number of rows hold it. Rows carry digest, shard, offset and length of the image; metadata columns
come from reading just the first HEADER_BYTES of a member, payloads from reading its range.

Shards lie in a folder that driver and executors share. A task writes each shard under a new name and gives its rows out
only when the shard is closed, and the rows are written as a table before they are read, so that a lost executor's task
leaves at most a file that nothing names. A shard holds at most SHARD_BYTES and one member.

Null and empty texts are stored as one block of 576 bytes. Repeated rows share a member. A null id is allowed; an empty
table makes no shard; further columns are ignored. A payload of any length must fit in a worker's memory.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

from evidentia.llm.arrow import small_batches, slices
from evidentia.llm.textscan import utf8
from evidentia.plans.workspace import Workspace

BLOCK = 576
WIDTH = 24
PAD = b"\xff"
SHARD_BYTES = 64 << 20
#: PNG's signature and its first chunk.
HEADER_BYTES = 33
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a shared folder: file: here, other schemes by Arrow's own."""
    parsed = urlparse(folder)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parsed.path)
    return fs.FileSystem.from_uri(folder)


def pad(raw: bytes) -> bytes:
    return raw + PAD * (-len(raw) % BLOCK if raw else BLOCK)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """A grey image, WIDTH samples a row, no filter."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def read_header(raw: bytes) -> tuple[int, int, int, int]:
    """width, height, bits a sample and colour kind from the first HEADER_BYTES of an image."""
    if raw[:8] != _SIGNATURE or raw[12:16] != b"IHDR":
        raise ValueError("not an image of this store")
    return struct.unpack(">IIBB", raw[16:26])


def from_png(raw: bytes) -> bytes:
    """The samples of an image that to_png made; every chunk's checksum is compared."""
    width, height, bits, kind = read_header(raw)
    if (bits, kind) != (8, 0):
        raise ValueError("not an image of this store")
    at, data = 8, []
    while at < len(raw):
        (size,) = struct.unpack_from(">I", raw, at)
        body = raw[at + 4 : at + 8 + size]
        if zlib.crc32(body) != struct.unpack_from(">I", raw, at + 8 + size)[0]:
            raise ValueError("damaged image")
        if body[:4] == b"IDAT":
            data.append(body[4:])
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("not an image of this store")
    return np.ascontiguousarray(lines[:, 1:]).tobytes()


class Shard:
    """A tar file that is written from start to end."""

    def __init__(self, folder: str):
        system, path = filesystem(folder)
        self.name = f"{uuid.uuid4().hex}.tar"
        system.create_dir(path, recursive=True)
        self.out = system.open_output_stream(f"{path}/{self.name}")
        self.at, self.places = 0, {}

    def add(self, media: bytes, digest: str) -> tuple[int, int]:
        """Offset and length of the member's bytes."""
        if digest not in self.places:
            info = tarfile.TarInfo(f"{digest}.png")
            info.size = len(media)
            head = info.tobuf(format=tarfile.USTAR_FORMAT)
            self.out.write(head)
            self.out.write(media)
            self.out.write(b"\0" * (-len(media) % tarfile.BLOCKSIZE))
            self.places[digest] = (self.at + len(head), len(media))
            self.at += len(head) + len(media) + -len(media) % tarfile.BLOCKSIZE
        return self.places[digest]

    def close(self) -> None:
        self.out.write(b"\0" * (2 * tarfile.BLOCKSIZE))
        self.out.close()


def store(docs: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, n_bytes, media_sha256, shard, offset, length; the shards are in work's folder `shards`."""
    folder = f"{work.path}/shards"
    small_batches(docs.sparkSession)
    names = ("doc_id", "n_bytes", "media_sha256", "shard", "offset", "length")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        made: dict[bytes, tuple[str, bytes]] = {}

        def done() -> pa.RecordBatch:
            shard.close()
            return pa.RecordBatch.from_pydict({k: pa.array(v, t) for k, v, t in zip(names, zip(*rows, strict=True), kinds, strict=True)})

        for batch in batches:
            for part in slices(batch):
                body, at = utf8(part.column("text"))
                raw, bounds = body.tobytes(), at.tolist()
                made.clear()
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), bounds, bounds[1:], strict=False):
                    key = hashlib.sha256(raw[a:b]).digest()
                    if key not in made:
                        media = to_png(pad(raw[a:b]))
                        made[key] = hashlib.sha256(media).hexdigest(), media
                    digest, media = made[key]
                    shard = shard or Shard(folder)
                    rows.append((doc_id, b - a, digest, shard.name, *shard.add(media, digest)))
                    if shard.at >= SHARD_BYTES:
                        yield done()
                        shard, rows = None, []
        if rows:
            yield done()

    return work.table("index", docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_bytes bigint, media_sha256 string, shard string, offset bigint, length bigint"))


def _ranges(batches: Iterator[pa.RecordBatch], folder: str, most: int | None) -> Iterator[tuple[pa.RecordBatch, Iterator[bytes]]]:
    """Each batch of an index with its rows' bytes, at most `most` of each; the shard in use stays open."""
    system, path = filesystem(folder)
    held: list = [None, None]

    def read(name: str, offset: int, length: int) -> bytes:
        if held[0] != name:
            if held[1]:
                held[1].close()
            held[:] = name, system.open_input_file(f"{path}/{name}")
        got = held[1].read_at(length if most is None else min(length, most), offset)
        if len(got) != (length if most is None else min(length, most)):
            raise OSError(f"{name} ends early")
        return got

    for batch in batches:
        yield batch, (read(*x) for x in zip(*(batch.column(k).to_pylist() for k in ("shard", "offset", "length")), strict=True))
    if held[1]:
        held[1].close()


def metadata(index: DataFrame, work: Workspace) -> DataFrame:
    """index with width, height and bits, of which only the members' headers are read."""
    folder = f"{work.path}/shards"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, heads in _ranges(batches, folder, HEADER_BYTES):
            width, height, bits, _ = zip(*map(read_header, heads), strict=True)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(width, pa.int32()), pa.array(height, pa.int64()), pa.array(bits, pa.int32())], [*batch.schema.names, "width", "height", "bits"])

    return index.mapInArrow(run, _ddl(index) + ", width int, height bigint, bits int")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def feature(payload: bytes, height: int) -> str:
    """Size, mean and spread of the samples, and how often each quarter of their range occurs."""
    samples = np.frombuffer(payload, np.uint8)
    quarters = np.bincount(samples >> 6, minlength=4).tolist()
    return f"{WIDTH}x{height};mean={samples.mean():.4f};std={samples.std():.4f};quarters={'/'.join(map(str, quarters))}"


def read_back(described: DataFrame, work: Workspace) -> DataFrame:
    """The op7 columns of an index with metadata, from the stored bytes."""
    folder = f"{work.path}/shards"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple | None = None
        for batch, stored in _ranges(batches, folder, None):
            rows = []
            for media, named, n, height in zip(stored, *(batch.column(k).to_pylist() for k in ("media_sha256", "n_bytes", "height")), strict=True):
                digest = hashlib.sha256(media).hexdigest()
                if digest != named:
                    raise ValueError("a member's bytes do not have its name's digest")
                if not known or known[0] != digest:
                    payload = from_png(media)
                    known = digest, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), digest, feature(payload, height))
                if not 0 <= known[1][0] - max(n, 1) < BLOCK:
                    raise ValueError("a payload's length does not fit its row")
                rows.append(known[1])
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n_bytes": batch.column("n_bytes"),
                **{k: pa.array(v, t) for k, v, t in zip(("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"), cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)},
            })

    return described.mapInArrow(run, "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")


def query(docs: DataFrame) -> DataFrame:
    """op7: every document's stored payload, read back."""
    work = Workspace(docs.sparkSession, "media")
    index = store(docs, work)
    return read_back(metadata(index, work), work)
