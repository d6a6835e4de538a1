"""Token ids in files of directly addressable codes.

An id is cut into chunks from its low bits on, one per level. Level 0 has the first chunk
of every id of the file; a bitmap tells which ids go on, and level 1 has the next chunk of
just those, and so on. The rank directory of a bitmap counts the ones before each block,
so any single id is found by one look per level, without decoding its neighbours.

A file, little-endian: 8 bytes magic, then 64-bit numbers (documents, ids, levels, and
for each level its chunk bits and entries), the ids of the documents, where each begins
and the last ends; then for each level its chunks, bitmap and rank directory, each padded
to 8 bytes. Bitmap and directory are left out where no id goes on.

Files are written by tasks over ranges of document ids below a shared folder; a table of
them, itself written there, names those of the attempts that counted. A file holds about
`file_ids` ids, and at least one document.

Defined cases: null and empty texts have just the end id; a null document id sorts first
and is read back as null; repeated document ids stay apart, in the order of their texts;
an empty table gives no files. Other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfdiff.llm import tokens, words
from shelfdiff.session import scratch_path, settle, ship

MAGIC = b"DACIDS01"
WIDTHS = (8, 8, 16)
BLOCK = 512  # bits to an entry of a rank directory
END_ID = 1
FILE_IDS = 4_000_000
NO_DOC = np.iinfo(np.int64).min  # stands for a null document id

_KINDS = {8: "<u1", 16: "<u2", 32: "<u4"}
# Ones in each byte value.
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1)


def _padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


def dump(doc_ids: np.ndarray, starts: np.ndarray, ids: np.ndarray, widths=WIDTHS) -> bytes:
    """A file's bytes: `starts` has one entry more than there are documents."""
    levels, rest = [], ids
    for i, width in enumerate(widths):
        if i and not len(rest):
            break
        last = i == len(widths) - 1
        chunk = rest if last else rest & np.uint32((1 << width) - 1)
        body = _padded(chunk.astype(_KINDS[width]).tobytes())
        high = np.zeros(0, np.uint32) if last else rest >> np.uint32(width)
        if len(high) and high.any():
            more = high > 0
            bits = np.packbits(more, bitorder="little")
            bits = np.pad(bits, (0, -len(bits) % (BLOCK // 8)))
            per_block = _ONES[bits].reshape(-1, BLOCK // 8).sum(1)
            ranks = np.concatenate([[0], np.cumsum(per_block)]).astype("<u8")
            body += bits.tobytes() + ranks.tobytes()
            high = high[more]
        else:
            high = high[:0]
        levels.append((width, len(rest), body))
        rest = high
    head = [len(doc_ids), len(ids), len(levels)]
    for width, n, _ in levels:
        head += [width, n]
    parts = [MAGIC, np.array(head, "<u8").tobytes(), doc_ids.astype("<i8").tobytes()]
    parts += [starts.astype("<u8").tobytes(), *[body for _, _, body in levels]]
    return b"".join(parts)


@dataclass
class _Level:
    width: int
    chunks: np.ndarray
    bits: np.ndarray | None
    ranks: np.ndarray | None


class DacFile:
    """Reads a file's bytes or memory map without copying them."""

    def __init__(self, data: bytes | memoryview):
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        at = 8

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += -(-out.nbytes // 8) * 8
            return out

        n_docs, self.n_ids, n_levels = (int(x) for x in take("<u8", 3))
        sizes = take("<u8", 2 * n_levels).reshape(-1, 2).tolist()
        self.doc_ids = take("<i8", n_docs)
        self.starts = take("<u8", n_docs + 1)
        self.levels: list[_Level] = []
        for i, (width, n) in enumerate(sizes):
            level = _Level(width, take(_KINDS[width], n), None, None)
            if i + 1 < n_levels:
                blocks = -(-n // BLOCK)
                level.bits = take("<u1", blocks * BLOCK // 8)
                level.ranks = take("<u8", blocks + 1)
            self.levels.append(level)

    def __getitem__(self, i: int) -> int:
        """One id, by one look per level."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value, shift = 0, 0
        for level in self.levels:
            value |= int(level.chunks[i]) << shift
            if level.bits is None or not level.bits[i >> 3] >> (i & 7) & 1:
                return value
            shift += level.width
            i = self._rank(level, i)
        raise ValueError("an id goes on beyond the last level")

    @staticmethod
    def _rank(level: _Level, i: int) -> int:
        """Ones of a level's bitmap before place `i`."""
        block = i // BLOCK
        lead = level.bits[block * BLOCK // 8 : i >> 3]
        part = int(level.bits[i >> 3]) & ((1 << (i & 7)) - 1)
        return int(level.ranks[block]) + int(_ONES[lead].sum()) + part.bit_count()

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo..hi-1, with one rank per level for all of them."""
        found = []
        for level in self.levels:
            chunks = level.chunks[lo:hi].astype(np.uint32)
            if level.bits is None or lo >= hi:
                found.append((level.width, chunks, None))
                break
            bits = np.unpackbits(level.bits[lo >> 3 : (hi + 7) >> 3], bitorder="little")
            more = bits[lo & 7 : (lo & 7) + hi - lo].astype(bool)
            found.append((level.width, chunks, more))
            first = self._rank(level, lo)
            lo, hi = first, first + int(more.sum())
        value = found[-1][1]
        for width, chunks, more in found[-2::-1]:
            high = np.zeros(len(chunks), np.uint32)
            high[more] = value
            value = chunks | (high << np.uint32(width))
        return value

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.starts[k]), int(self.starts[k + 1]))


def _open(uri: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "", 1))


def _write(uri: str, data: bytes) -> None:
    """Writes beside the name and renames, so that a name always has a whole file."""
    system, path = _open(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path + ".part") as out:
        out.write(data)
    system.move(path + ".part", path)


def _read(uri: str) -> memoryview:
    system, path = _open(uri)
    with system.open_input_file(path) as f:
        return memoryview(f.read_buffer())


MANIFEST = "part int, file_no int, path string, n_docs long, n_ids long"
_MANIFEST_ARROW = pa.schema(
    [("part", pa.int32()), ("file_no", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
)


def write_ids(
    docs: DataFrame,
    folder: str | None = None,
    tokenizer: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    file_ids: int = FILE_IDS,
    partitions: int | None = None,
) -> DataFrame:
    """Writes the ids of all documents below `folder` (default: the shared folder) and
    returns the table of the files: path, documents, ids, and the ids in files before it.

    Documents are dealt by ranges of their id and written in its order."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "dac")
    path = tokenizer or tokens.default_path()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        words.keep_only("tokens")
        encoder = tokens.encoder(path)
        end = np.array([END_ID], "<u4").tobytes()
        names: list[int] = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            lengths = np.fromiter(map(len, held), np.int64, len(held)) // 4
            starts = np.concatenate([[0], np.cumsum(lengths)])
            ids = np.frombuffer(b"".join(held), "<u4")
            uri = f"{folder}/ids-{part:06d}-{number:05d}-{uuid.uuid4().hex}.dac"
            _write(uri, dump(np.array(names, np.int64), starts, ids))
            row = {"part": part, "file_no": number, "path": uri, "n_docs": len(names), "n_ids": len(ids)}
            return pa.RecordBatch.from_pylist([row], _MANIFEST_ARROW)

        for batch in batches:
            for i, t in zip(batch["doc_id"], batch["text"], strict=True):
                i = i.as_py()
                data = encoder.ids(t.as_py()) + end
                if held and size + len(data) // 4 > file_ids:
                    yield flush()
                    names.clear()
                    held.clear()
                    size, number = 0, number + 1
                names.append(NO_DOC if i is None else i)
                held.append(data)
                size += len(data) // 4
        if held:
            yield flush()

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = plain.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    # The table is written by the same job: an attempt that is repeated writes files of
    # other names, and only those in the table count.
    files = settle(ordered.mapInArrow(write, MANIFEST), "dac-files")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("all_ids"))
    # One row per task here: bounded by the number of partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("all_ids").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    lead = F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    return files.join(parts, "part").select(
        "path", "n_docs", "n_ids", (F.col("base") + lead).alias("ids_before")
    )


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids of every document in `files`."""
    spark: SparkSession = files.sparkSession
    ship(spark)
    names = [x.split()[0] for x in READ.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, before in zip(batch["path"].to_pylist(), batch["ids_before"].to_pylist(), strict=True):
                file = DacFile(_read(uri))
                starts = file.starts.astype(np.int64)
                sums = [zlib.crc32(file.document(k).astype("<u4").tobytes()) for k in range(len(file.doc_ids))]
                names_of = pa.array(file.doc_ids, mask=file.doc_ids == NO_DOC)
                columns = [names_of, pa.array(starts[:-1] + before), pa.array(np.diff(starts)), pa.array(sums, pa.int64())]
                yield pa.record_batch(columns, names)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, "path").mapInArrow(read, READ)
