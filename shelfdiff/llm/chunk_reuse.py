"""Encoding and decoding of texts whose chunks recur in other texts.

A rolling hash over the characters cuts texts into chunks by content, so that equal
passages have equal chunks whatever stands before them. Hashes of all chunks are counted;
a chunk that occurs more than once is shared, and goes to a table in which each distinct
chunk is encoded once. All other chunks are encoded where they stand, neighbours among them
as one, so that they need no joins; a text without shared chunks is encoded as it is.

A chunk may begin or end inside a word, where its ids differ from those of the whole text.
So the words around every join with a shared chunk are encoded again, with one more word on each
side until the outer words come out as they do alone: the ids between them then replace
those of the two chunk ends. What the ends must be goes along and is checked when a text
is put together.

Whether a chunk is shared is known in tasks from a bitmap over the hashes of shared chunks,
of a bounded size. A chunk that it reports wrongly is encoded in the table too, which
costs a row and changes nothing.

Chunks are cut only for a tokenizer that is known to split at spaces and newlines; texts of
any other, and texts without such words around a join, are encoded whole.

Defined cases: null texts count as empty and have no ids; a null document id is kept;
repeated rows give a row each; an empty table gives an empty result. Strings of special
tokens are what the tokenizer makes of them. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm import tokens, words
from shelfdiff.session import settle, ship

WINDOW = 24  # characters that decide about a cut
LEAST = 256  # characters between cuts
CUT_BITS = 9  # a window in 512 is a cut
BITS_EACH = 16  # of the bitmap, for a shared chunk
MOST_BITS = 1 << 27  # 16 MB
SEEN = 200_000

# Factors of the rolling hash and what undoes it, modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_UNDO = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of the base and of its inverse, as many as the longest text needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 1 << 16)
            self.up = np.cumprod(np.full(n, _BASE, np.uint64))
            self.down = np.cumprod(np.full(n, _UNDO, np.uint64))


_POWERS = _Powers()


def cuts(text: str) -> list[int]:
    """Where the chunks of a text end, its own end included."""
    n = len(text)
    if n < 2 * LEAST:
        return [n] if n else []
    characters = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    _POWERS.grow(n)
    total = np.cumsum(characters * _POWERS.up[:n])
    total[WINDOW:] -= total[:-WINDOW].copy()
    hashes = total * _POWERS.down[:n] * _MIX
    out, last = [], 0
    for at in (np.flatnonzero(hashes[WINDOW - 1 :] >> np.uint64(64 - CUT_BITS) == 0) + WINDOW).tolist():
        if at - last >= LEAST and n - at >= LEAST:
            out.append(at)
            last = at
    return [*out, n]


def chunks(text: str, cut: bool = True) -> list[str]:
    out, last = [], 0
    for at in cuts(text) if cut else [len(text)] if text else []:
        out.append(text[last:at])
        last = at
    return out


def _digest(chunk: str) -> bytes:
    return xxhash.xxh3_128_digest(chunk.encode())


class Join:
    """The repaired join of two chunks: the ids that their ends have alone, and those
    that take their place."""

    def __init__(self, tail: bytes, head: bytes, ids: bytes, tail_size: int, head_size: int):
        self.tail, self.head, self.ids = tail, head, ids
        self.tail_size, self.head_size = tail_size, head_size


def _before(text: str, end: int) -> int:
    return max(text.rfind(" ", 0, end), text.rfind("\n", 0, end))


def _after(text: str, begin: int) -> int:
    found = [x for x in (text.find(" ", begin), text.find("\n", begin)) if x >= 0]
    return min(found, default=-1)


def repaired(left: str, right: str, encode) -> Join | None:
    """The join of two chunks, or None where no words around it agree."""
    a, b = _before(left, len(left)), _after(right, 0)
    while a >= 0 and b >= 0:
        wider_a, wider_b = _before(left, a), _after(right, b + 1)
        if wider_a < 0 or wider_b < 0:
            return None
        ids = encode(left[a:] + right[:b])
        wider = encode(left[wider_a:] + right[:wider_b])
        if wider == encode(left[wider_a:a]) + ids + encode(right[b:wider_b]):
            return Join(encode(left[a:]), encode(right[:b]), ids, len(left) - a, b)
        a, b = wider_a, wider_b
    return None


def joins(parts: list[str], encode) -> list[Join] | None:
    """The joins of a text's chunks, or None if it must be encoded whole."""
    out: list[Join] = []
    begun = 0
    for left, right in zip(parts, parts[1:], strict=False):
        join = repaired(left, right, encode)
        if join is None or begun + join.tail_size > len(left):
            return None
        out.append(join)
        begun = join.head_size
    return out


def trimmed(ids: bytes, head: bytes, tail: bytes) -> bytes:
    """A chunk's ids without those that its joins replace."""
    if not ids.startswith(head) or not ids.endswith(tail) or len(head) + len(tail) > len(ids):
        raise RuntimeError("the ends of a chunk do not agree with its joins")
    return ids[len(head) : len(ids) - len(tail)]


class _Digests:
    """Results of whole texts."""

    def __init__(self, path: str):
        self.tokenizer = tokens.encoder(path).tokenizer
        size = self.tokenizer.get_vocab_size()
        self.names = [str(i) for i in range(size)]
        # Without a decoder, the library puts a space between the tokens. A number without a
        # token would be left out there.
        found = [self.tokenizer.id_to_token(i) for i in range(size)]
        self.tokens = found if self.tokenizer.decoder is None and None not in found else None

    def decoded(self, numbers: list[int]) -> str:
        if self.tokens is not None:
            return " ".join(map(self.tokens.__getitem__, numbers))
        return self.tokenizer.decode(numbers, skip_special_tokens=False)

    def of(self, ids: bytes) -> tuple[int, str, str]:
        numbers = np.frombuffer(ids, "<u4").tolist()
        text = self.decoded(numbers)
        listed = " ".join(map(self.names.__getitem__, numbers))
        return len(numbers), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


class _Packed:
    """Ids as stored: two bytes each where the vocabulary allows it."""

    def __init__(self, path: str):
        small = tokens.encoder(path).tokenizer.get_vocab_size() <= 1 << 16
        self.kind = "<u2" if small else "<u4"

    def pack(self, ids: bytes) -> bytes:
        return np.frombuffer(ids, "<u4").astype(self.kind).tobytes()

    def unpack(self, data: bytes) -> bytes:
        return np.frombuffer(data, self.kind).astype("<u4").tobytes()


def _places(digests: list[bytes], bits: int) -> np.ndarray:
    low = np.frombuffer(b"".join(d[:8] for d in digests), "<u8")
    return (low & np.uint64(bits - 1)).astype(np.int64)


def _shared(docs: DataFrame, cut: bool) -> DataFrame:
    """Digests of chunks that occur more than once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, int] = {}
            for text in batch["text"]:
                for chunk in chunks(text.as_py() or "", cut):
                    digest = _digest(chunk)
                    seen[digest] = seen.get(digest, 0) + 1
            yield pa.record_batch(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["digest", "n"]
            )

    found = docs.select("text").mapInArrow(count, "digest binary, n long")
    return found.groupBy("digest").agg(F.sum("n").alias("n")).filter("n > 1").select("digest")


def _bitmap(shared: DataFrame) -> tuple[int, np.ndarray]:
    """Bits of the bitmap and the bitmap: one bit of each shared digest is set. Spark sets
    the bits; the driver gets at most MOST_BITS of them, as 64-bit words."""
    n = shared.count()
    bits = 1 << 10
    while bits < min(BITS_EACH * n, MOST_BITS):
        bits *= 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _places(batch["digest"].to_pylist(), bits)
            yield pa.record_batch([pa.array(at >> 6), pa.array(at & 63)], ["word", "bit"])

    set_bits = shared.mapInArrow(place, "word long, bit long")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").cast("int"))
    found = set_bits.groupBy("word").agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits, out


def _is_set(filter_bits: tuple[int, np.ndarray], digests: list[bytes]) -> list[bool]:
    bits, table = filter_bits
    at = _places(digests, bits)
    return (table[at >> 6] >> (at & 63) & 1).astype(bool).tolist()


def _dictionary(docs: DataFrame, bitmap, path: str, cut: bool) -> DataFrame:
    """digest and ids of every chunk that the bitmap reports, encoded once."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            out: dict[bytes, str] = {}
            for text in batch["text"]:
                parts = chunks(text.as_py() or "", cut)
                digests = [_digest(p) for p in parts]
                for digest, part, hit in zip(digests, parts, _is_set(bitmap.value, digests), strict=True):
                    if hit and digest not in seen:
                        out[digest] = part
                        seen.add(digest)
            if len(seen) > SEEN:
                seen.clear()
            yield pa.record_batch(
                [pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.string())], ["digest", "text"]
            )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("tokens")
        encoder, packed = tokens.encoder(path), _Packed(path)
        for batch in batches:
            ids = [packed.pack(encoder.ids(t.as_py())) for t in batch["text"]]
            yield pa.record_batch([batch["digest"], pa.array(ids, pa.binary())], ["digest", "ids"])

    distinct = docs.select("text").mapInArrow(texts, "digest binary, text string").dropDuplicates(["digest"])
    return distinct.mapInArrow(encode, "digest binary, ids binary")


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_RESULT = [x.split()[0] for x in RESULT.split(", ")]
# A whole text has its results; a piece has its ids or its chunk's digest, the ids that the
# chunk's ends must have, and those that follow it.
PIECES = f"row long, {RESULT}, piece int, digest binary, ids binary, head binary, tail binary, joint binary"
_ARROW = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string())]
    + [("decoded_sha256", pa.string()), ("piece", pa.int32())]
    + [(x, pa.binary()) for x in ("digest", "ids", "head", "tail", "joint")]
)


def _pieces_of(text: str, encode, is_set, cut: bool) -> list[dict] | bytes:
    """The pieces of a text in order, or all its ids if none of its chunks is shared.
    Neighbouring chunks that are not shared are one piece."""
    found = chunks(text, cut)
    digests = [_digest(p) for p in found]
    hits = is_set(digests)
    if not any(hits):
        return encode(text)
    parts: list[str] = []
    shared: list[bytes | None] = []
    for part, digest, hit in zip(found, digests, hits, strict=True):
        if not hit and shared and shared[-1] is None:
            parts[-1] += part
            continue
        parts.append(part)
        shared.append(digest if hit else None)
    between = joins(parts, encode)
    if between is None:
        return encode(text)
    out: list[dict] = []
    for k, (part, digest) in enumerate(zip(parts, shared, strict=True)):
        head = between[k - 1].head if k else b""
        tail, joint = (between[k].tail, between[k].ids) if k < len(between) else (b"", b"")
        if digest is None:
            out.append({"ids": trimmed(encode(part), head, tail) + joint})
        else:
            out.append({"digest": digest, "head": head, "tail": tail, "joint": joint})
    return out


def _split(docs: DataFrame, bitmap, path: str, cut: bool) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("tokens")
        encoder, packed, digests = tokens.encoder(path), _Packed(path), _Digests(path)
        is_set = lambda found: _is_set(bitmap.value, found)
        for batch in batches:
            rows = []
            for row, name, text in zip(
                batch["row"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"], strict=True
            ):
                found = _pieces_of(text.as_py() or "", encoder.ids, is_set, cut)
                if isinstance(found, bytes):
                    rows.append(dict(zip(_RESULT, (name, *digests.of(found)), strict=True)) | {"row": row})
                    continue
                for k, piece in enumerate(found):
                    stored = {c: packed.pack(v) for c, v in piece.items() if c != "digest"}
                    rows.append({"row": row, "doc_id": name, "piece": k, "digest": piece.get("digest")} | stored)
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return numbered.mapInArrow(work, PIECES)


def _assembled(pieces: DataFrame, path: str) -> DataFrame:
    """Results of texts from their pieces, which all have ids by now."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("tokens")
        packed, digests = _Packed(path), _Digests(path)
        now: int | None = None
        name: int | None = None
        held: list[bytes] = []

        def result() -> tuple:
            return (name, *digests.of(packed.unpack(b"".join(held))))

        for batch in batches:
            done = []
            columns = [batch[c].to_pylist() for c in ("row", "doc_id", "digest", "ids", "head", "tail", "joint")]
            for row, doc, digest, ids, head, tail, joint in zip(*columns, strict=True):
                if row != now:
                    if held:
                        done.append(result())
                    now, name, held = row, doc, []
                held.append(ids if digest is None else trimmed(ids, head, tail) + joint)
            yield _batch(done)
        if held:
            yield _batch([result()])

    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.repartition(n, "row").sortWithinPartitions("row", "piece")
    return ordered.mapInArrow(work, RESULT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], _RESULT)


def encode_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    spark = docs.sparkSession
    ship(spark)
    path = tokenizer or tokens.default_path()
    cut = tokens.encoder(path).known_steps
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    bitmap = spark.sparkContext.broadcast(_bitmap(settle(_shared(plain, cut), "chunks-shared")))
    ids = _dictionary(plain, bitmap, path, cut)
    pieces = settle(_split(plain, bitmap, path, cut), "chunks-pieces")
    whole = pieces.filter("piece is null").select(_RESULT)
    columns = ["row", "doc_id", "piece", "digest", "ids", "head", "tail", "joint"]
    own = pieces.filter("piece is not null and digest is null").select(columns)
    reused = pieces.filter("digest is not null").drop("ids").join(ids, "digest").select(columns)
    return whole.unionByName(_assembled(own.unionByName(reused), path))
