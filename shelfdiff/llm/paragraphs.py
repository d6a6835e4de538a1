"""Repeated passages, paragraph by paragraph, by banded MinHash.

A paragraph is what stands between two \\n and has at least `MIN_WORDS` words. Paragraphs
of equal words form a class; one of each class goes on. `bands` finds how many bands of
how many MinHash values a paragraph needs so that a pair at the least similarity collides
in some band with the recall asked for. Colliding paragraphs are paired, the exact Jaccard
similarity of their five-word shingles decides, and confirmed pairs are clustered by
components. Of each cluster the first paragraph, by document id and place, stays.

Band values are sorted and cut into ranges for the tasks. Buckets of up to `SMALL`
paragraphs have all their pairs taken. The paragraphs of larger ones, which come of big
groups of copies, get more MinHash values and are paired by these, bucket by bucket, as
regions of a forest are: with a hub, with their best partners, and split further where
there are too many. So are those of buckets that a cut may run through. That is a first
look: such a bucket whose paragraphs are not all one component after it is compared in
full, block against block (`dense`).

Passages are found wherever they stand, inside longer lines or over several short ones:
`find_passages` gives every run of `RUN` equal words that stands at an earlier place too.
Of the windows of `GRAM` words the least of every `RUN - GRAM + 1` neighbours are taken, so
that two equal runs have one in common. Around those that occur again, windows of `RUN`
words are compared by their hashes; neighbouring ones make up a passage. Of texts with
equal words only the first is looked at in this way: the others are passages as a whole.

Defined cases: null and empty texts have no paragraphs; repeated rows are equal documents,
of whose equal places either none or all go; a null document id comes before all others;
an empty table gives an empty result. Other columns are ignored by `find_repeats` and
passed on by `remove_repeats`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfdiff.llm import dense, forest, words
from shelfdiff.llm.components import components
from shelfdiff.llm.spark_tools import few
from shelfdiff.session import settle, ship

MIN_WORDS = 25
PERCENT = 75
RECALL = 0.999
SMALL = 16
ROWS_PER_TASK = 300_000

# Words of a passage, and of the windows by which its places are found.
RUN = 50
GRAM = 25


def bands(similarity: float = PERCENT / 100, recall: float = RECALL, most: int = 24) -> tuple[int, int]:
    """(bands, values per band): the longest bands of which at most `most` values in all
    give the recall at this similarity."""
    best = None
    for size in range(1, most + 1):
        n = 1
        while 1 - (1 - similarity**size) ** n < recall:
            n += 1
        if n * size <= most:
            best = (n, size)
    if best is None:
        raise ValueError("no banding of so few values has this recall")
    return best


N_BANDS, BAND = bands()
_RANDOM = np.random.default_rng(31)
_XOR = _RANDOM.integers(0, 2**32, N_BANDS * BAND, dtype=np.uint32)
_FACTOR = _RANDOM.integers(0, 2**31, N_BANDS * BAND, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_JOIN = _RANDOM.integers(1, 2**63, GRAM // words.SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _digests(texts: words.Texts, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """(text, place, words, digest, band values) of every paragraph of some texts."""
    hashes = texts.hashes()
    starts, ends, first = texts.lines()
    line = np.flatnonzero(ends - starts >= least)
    starts, ends = starts[line], ends[line]
    of = np.searchsorted(first, line, side="right") - 1
    keys = np.zeros((len(line), N_BANDS), np.uint64)
    if len(line):
        grams = words.windows(hashes, words.SHINGLE).astype(np.uint32)
        # Those within a paragraph, one paragraph after another.
        place, at = words.ranges(starts, ends - starts - words.SHINGLE + 1)
        values = grams[place]
        low = np.empty((len(line), N_BANDS * BAND), np.uint32)
        for k in range(N_BANDS * BAND):
            low[:, k] = np.minimum.reduceat((values ^ _XOR[k]) * _FACTOR[k], at)
        for k in range(BAND):
            keys = words.mix(keys + low[:, k::BAND] + np.arange(1, N_BANDS + 1, dtype=np.uint64))
    digests = [xxhash.xxh3_128_digest(hashes[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    return of, line - first[of], ends - starts, digests, keys.view(np.int64)


PARAGRAPHS = "doc_id long, paragraph int, n_words int, digest binary, bands array<long>"


def paragraph_bands(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """Every paragraph with a digest of its words and its band values."""
    names = [x.split()[0] for x in PARAGRAPHS.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("words")
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                of, places, sizes, digests, keys = _digests(words.Texts(part["text"]), min_words)
                if not len(of):
                    continue
                offsets = pa.array(np.arange(len(of) + 1, dtype=np.int32) * N_BANDS)
                columns = [
                    part["doc_id"].take(pa.array(of)),
                    pa.array(places.astype(np.int32)),
                    pa.array(sizes.astype(np.int32)),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                ]
                yield pa.record_batch(columns, names)

    ship(docs.sparkSession)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(cut, PARAGRAPHS)


def collisions(classes: DataFrame) -> DataFrame:
    """Settled rows of what collides in a band; `classes` has id and bands.

    Pairs (a, b) of small buckets; a with `dense`, the bucket's key, for each paragraph of
    a large one and of each that a cut may run through, which have `edge`, the key, too."""
    spark = classes.sparkSession
    ship(spark)
    rows = classes.select("id", F.explode("bands").alias("key"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(n, -(-classes.count() * N_BANDS // ROWS_PER_TASK))
    ordered = rows.repartitionByRange(tasks, "key", "id").sortWithinPartitions("key", "id")
    names = ["a", "b", "dense", "edge"]

    def rows_of(a: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.record_batch([pa.array(a), *[pa.array(more[c]) if c in more else none for c in names[1:]]], names)

    def collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A range holds about ROWS_PER_TASK rows of two numbers.
        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        keys, ids = table["key"].to_numpy(), table["id"].to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        sizes = np.diff(bounds)
        size_of = np.repeat(sizes, sizes)
        left, right = [], []
        for k in range(1, SMALL):
            # Rows that far apart in one small bucket.
            same = (keys[:-k] == keys[k:]) & (size_of[:-k] <= SMALL)
            left.append(ids[:-k][same])
            right.append(ids[k:][same])
        a, b = np.concatenate(left), np.concatenate(right)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b], axis=0)
        yield rows_of(pairs[:, 0], b=pairs[:, 1])
        at_end = (keys == keys[0]) | (keys == keys[-1])
        many = (size_of > SMALL) & ~at_end
        yield rows_of(ids[many], dense=keys[many])
        yield rows_of(ids[at_end], dense=keys[at_end], edge=keys[at_end])

    found = ordered.select("key", "id").mapInArrow(collide, "a long, b long, dense long, edge long")
    return settle(found, "collisions")


def _dense_pairs(crowded: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs within large buckets: `crowded` has id and key, `sets` the sets of all ids."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [forest.min_hashes(np.frombuffer(x.as_buffer(), np.uint64)) for x in batch["set"]]
            more = pa.array([v[: forest.DEPTH - 2].tobytes() for v in values], pa.binary())
            marks = pa.array([v.astype(np.uint8).tobytes() for v in values], pa.binary())
            yield pa.record_batch([batch["doc_id"], more, marks], ["doc_id", "more", "marks"])

    own = sets.join(few(settle(crowded.select(F.col("id").alias("doc_id")).distinct(), "dense")), "doc_id", "left_semi")
    signed = settle(own.mapInArrow(sign, "doc_id long, more binary, marks binary"), "dense-values")
    key = F.unhex(F.lpad(F.hex("key"), 16, "0"))
    rows = crowded.join(signed, F.col("id") == F.col("doc_id")).select(
        F.lit(0).alias("tree"), F.concat(key, "more").alias("key"), "doc_id", "marks"
    )
    rows = settle(rows, "dense-rows")
    return forest.sorted_pairs(rows, rows.count())


def _dense_links(crowded: DataFrame, cut: DataFrame, sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Links between the components (`found`) that lie apart in one large or cut bucket.

    `crowded` has id and key, `cut` the keys (region) of buckets that a cut may run through."""
    sizes = sets.select("doc_id", F.expr("octet_length(set) div 8").alias("n_shingles"))
    rows = crowded.select(F.col("key").alias("region"), F.col("id").alias("doc_id"))
    named = rows.join(sizes, "doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    placed = settle(named.withColumn("component", F.coalesce("component", "doc_id")), "dense-placed")
    regions = settle(dense.open_regions(placed, cut, SMALL), "open-buckets")
    rows = placed.drop("n_shingles").join(few(regions.select("region")), "region", "left_semi")
    return settle(dense.links(rows, regions, sets, percent), "dense-links")


def _sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The shingle sets (doc_id: the id of a class, set) of the classes in `wanted`, which
    has id and first, the place of one paragraph of each."""
    by_doc = wanted.groupBy(F.col("first.doc_id").alias("of")).agg(
        F.collect_list(F.struct(F.col("first.paragraph").alias("paragraph"), "id")).alias("wanted")
    )
    by_doc = settle(by_doc, "wanted")
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined = plain.join(few(by_doc), F.col("doc_id").eqNullSafe(F.col("of"))).select("text", "wanted")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                ids, sets = [], []
                texts = words.Texts(part["text"])
                hashes = texts.hashes()
                starts, ends, first = texts.lines()
                for lo, hi, places in zip(first[:-1], first[1:], part["wanted"].to_pylist(), strict=True):
                    for place in places:
                        k = lo + place["paragraph"]
                        if k < hi:
                            ids.append(place["id"])
                            sets.append(words.shingles(hashes[starts[k] : ends[k]]).tobytes())
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "set"])

    found = joined.mapInArrow(extract, "doc_id long, set binary")
    return found.groupBy("doc_id").agg(F.min("set").alias("set"))


def find_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per paragraph that repeats an earlier one: doc_id, paragraph (its place
    among the lines, from 0), n_words, and kept_doc_id and kept_paragraph, which stay."""
    if percent < PERCENT:
        raise ValueError(f"bands are laid out for {PERCENT} % and more")
    every = settle(paragraph_bands(docs, doc_id, text, min_words), "paragraphs")
    classes = every.groupBy("digest").agg(
        F.min(F.struct("doc_id", "paragraph")).alias("first"),
        F.count(F.lit(1)).alias("n"),
        F.min("bands").alias("bands"),
    )
    # Pairs and sets go by 64 bits of the digest.
    short = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")
    classes = settle(classes.withColumn("id", short), "paragraph-classes")
    found = collisions(classes.select("id", "bands"))
    pairs = found.filter("b is not null").select("a", "b")
    cut = found.filter("edge is not null").select(F.col("edge").alias("region")).distinct()
    crowded = found.filter("dense is not null").select(F.col("a").alias("id"), F.col("dense").alias("key")).distinct()
    ids = [pairs.select(F.col(c).alias("id")) for c in ("a", "b")]
    ids = ids[0].unionByName(ids[1]).unionByName(crowded.select("id")).distinct()
    wanted = classes.select("id", "first").join(ids, "id", "left_semi")
    sets = settle(_sets(docs, wanted, doc_id, text), "paragraph-sets")
    pairs = pairs.unionByName(_dense_pairs(crowded, sets)).filter("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = settle(forest.confirmed(pairs, sets, percent), "paragraph-links")
    found = components(links)
    more = _dense_links(crowded, cut, sets, found, percent)
    if not more.isEmpty():
        found = components(links.unionByName(more))
    labelled = classes.select("digest", "id", "n", "first").join(found, F.col("id") == F.col("node"), "left")
    labelled = labelled.withColumn("label", F.coalesce("component", "id"))
    groups = labelled.groupBy("label").agg(F.sum("n").alias("total"), F.min("first").alias("kept"))
    groups = groups.filter("total > 1")
    kept = labelled.select("digest", "label").join(groups, "label").select("digest", "kept")
    rows = every.select("doc_id", "paragraph", "n_words", "digest").join(kept, "digest")
    stays = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("paragraph") == F.col("kept.paragraph"))
    return rows.filter(~stays).select(
        "doc_id",
        "paragraph",
        "n_words",
        F.col("kept.doc_id").alias("kept_doc_id"),
        F.col("kept.paragraph").alias("kept_paragraph"),
    )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """`docs` without the paragraphs that repeat earlier ones; all rows and columns stay."""
    gone = find_repeats(docs, doc_id, text, **rules)
    lists = gone.groupBy(F.col("doc_id").alias("__of")).agg(F.collect_set("paragraph").alias("__gone"))
    joined = docs.join(lists, F.col(doc_id).cast("long").eqNullSafe(F.col("__of")), "left")
    lines = F.split(F.col(text), "\n")
    rest = F.filter(lines, lambda line, i: ~F.array_contains(F.col("__gone"), i))
    cleaned = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(rest, "\n"))
    return joined.withColumn(text, cleaned).select(*docs.columns)


def _joined(hashes: np.ndarray, parts: int, step: int) -> np.ndarray:
    """A hash of every `parts` values that stand `step` apart."""
    n = max(0, len(hashes) - (parts - 1) * step)
    total = np.zeros(n, np.uint64)
    for k in range(parts):
        total += hashes[k * step : k * step + n] * _JOIN[k]
    return words.mix(total + np.uint64(parts))


def _grams(hashes: np.ndarray) -> np.ndarray:
    """A hash of every `GRAM` words in a row."""
    return _joined(words.windows(hashes, words.SHINGLE), GRAM // words.SHINGLE, words.SHINGLE)


def _over(values: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """The best of every `size` values in a row."""
    out, width = values, 1
    while width < size:
        step = min(width, size - width)
        out = best(out[: len(out) - step], out[step:])
        width += step
    return out


def _chosen(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows of `GRAM` words that are least among those of some
    `RUN` words in a row, in texts that begin and end at these places among all words."""
    if len(hashes) < RUN:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = _grams(hashes)
    size = RUN - GRAM + 1
    least = _over(grams, size, np.minimum)
    # Runs that begin in the last words of a text don't lie within it.
    inside = np.zeros(len(hashes) + 1, np.int64)
    whole = ends - starts >= RUN
    np.add.at(inside, starts[whole], 1)
    np.add.at(inside, ends[whole] - RUN + 1, -1)
    least[np.cumsum(inside)[: len(least)] == 0] = 0
    edge = np.zeros(size - 1, np.uint64)
    most = _over(np.concatenate([edge, least, edge]), size, np.maximum)
    places = np.flatnonzero((most == grams) & (grams > 0))
    return places, grams[places]


def _fingerprints(docs: DataFrame) -> DataFrame:
    """One row per text of at least `RUN` words: doc_id, n_words, line (of its first word), a
    digest of its words, and the places (word) and hashes (gram) of its chosen windows."""
    names = ["doc_id", "n_words", "line", "digest", "word", "gram"]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("words")
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                texts = words.Texts(part["text"])
                hashes = texts.hashes()
                long = np.flatnonzero(np.diff(texts.first) >= RUN)
                if not len(long):
                    continue
                starts, ends = texts.first[long], texts.first[long + 1]
                places, grams = _chosen(hashes, starts, ends)
                bounds = pa.array(np.concatenate([[0], np.searchsorted(places, ends)]).astype(np.int32))
                places = places - starts[np.searchsorted(ends, places, side="right")]
                # The line of a text's first word.
                _, line_ends, first = texts.lines()
                lines = np.searchsorted(line_ends, starts, side="right") - first[long]
                digests = [xxhash.xxh3_128_digest(hashes[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [
                    part["doc_id"].take(pa.array(long)),
                    pa.array((ends - starts).astype(np.int32)),
                    pa.array(lines.astype(np.int32)),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(bounds, pa.array(places.astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(grams.view(np.int64))),
                ]
                yield pa.record_batch(columns, names)

    kinds = "doc_id long, n_words int, line int, digest binary, word array<int>, gram array<long>"
    return docs.mapInArrow(choose, kinds)


def _windows_at(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """The windows of `RUN` words around the hits (of, places): run (a hash), doc_id, word,
    and the line in which the window begins."""
    names = ["run", "doc_id", "word", "line"]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("words")
        for batch in batches:
            for i in range(0, batch.num_rows, 100):
                part = batch.slice(i, 100)
                runs, places, lines = [], [], []
                texts = words.Texts(part["text"])
                every = texts.hashes()
                _, line_ends, first = texts.lines()
                for k, hit in enumerate(part["places"]):
                    lo, hi = texts.first[k : k + 2]
                    hashes, ends = every[lo:hi], line_ends[first[k] : first[k + 1]] - lo
                    values = _joined(_grams(hashes), RUN // GRAM, GRAM)
                    hit = hit.values.to_numpy(zero_copy_only=False)
                    # Windows that hold a hit whole.
                    ends_at = np.zeros(max(len(hashes), int(hit.max()) + 1) + 1, np.int64)
                    np.add.at(ends_at, np.maximum(hit - (RUN - GRAM), 0), 1)
                    np.add.at(ends_at, hit + 1, -1)
                    at = np.flatnonzero(np.cumsum(ends_at)[: len(values)] > 0)
                    runs.append(values[at])
                    places.append(at)
                    lines.append(np.searchsorted(ends, at, side="right"))
                of = np.repeat(np.arange(part.num_rows), [len(x) for x in places])
                columns = [
                    pa.array(np.concatenate(runs).view(np.int64)),
                    part["doc_id"].take(pa.array(of)),
                    pa.array(np.concatenate(places).astype(np.int32)),
                    pa.array(np.concatenate(lines).astype(np.int32)),
                ]
                yield pa.record_batch(columns, names)

    ids = few(hits.select("of"))
    some = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("of")), "left_semi")
    joined = some.join(hits, F.col("doc_id").eqNullSafe(F.col("of"))).select("doc_id", "text", "places")
    return joined.mapInArrow(extract, "run long, doc_id long, word int, line int")


def find_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per passage of at least `RUN` words that stands at an earlier place too, by
    document id and word: doc_id, paragraph (the line it begins in), word (its first one's
    place in the text, from 0), n_words, and the same of the earlier place.

    A text whose words equal those of an earlier one is one passage. Within a document,
    only what doesn't overlap its earlier place is a repeat. Repeated rows are one place."""
    ship(docs.sparkSession)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = settle(_fingerprints(plain), "passage-grams")
    equal = signed.groupBy("digest").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
    equal = few(settle(equal.filter("n > 1").select("digest", "first"), "passage-texts"))
    signed = signed.join(equal, "digest", "left")
    is_copy = F.col("first").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    zero = F.lit(0)
    copies = signed.filter(is_copy).select(
        "doc_id", "line", zero.alias("word"), "n_words", F.col("first.doc_id").alias("of"),
        F.col("first.line").alias("of_line"), zero.alias("of_word"),
    ).distinct()
    grams = signed.filter(~is_copy).select("doc_id", F.inline(F.arrays_zip("word", "gram")))
    again = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    hits = grams.join(few(settle(again, "passage-again")), "gram", "left_semi")
    hits = hits.groupBy(F.col("doc_id").alias("of")).agg(F.collect_set("word").alias("places"))
    every = settle(_windows_at(plain, settle(hits, "passage-hits")), "passage-windows")
    first = every.groupBy("run").agg(F.min(F.struct("doc_id", "word", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1").select(
        "run", F.col("first.doc_id").alias("of"), F.col("first.word").alias("of_word"), F.col("first.line").alias("of_line")
    )
    apart = F.col("word") - F.col("of_word")
    rows = every.join(few(settle(first, "passage-first")), "run").withColumn("apart", apart).drop("run")
    rows = rows.filter(~F.col("doc_id").eqNullSafe(F.col("of")) | (F.col("apart") >= RUN))
    order = Window.partitionBy("doc_id", "of", "apart").orderBy("word")
    rows = rows.withColumn("stretch", F.col("word") - F.dense_rank().over(order))
    found = rows.groupBy("doc_id", "of", "apart", "stretch").agg(
        F.min("line").alias("line"), F.min("word").alias("word"), F.max("word").alias("last"), F.min("of_line").alias("of_line")
    )
    found = found.withColumn("n_words", F.col("last") - F.col("word") + RUN).withColumn("of_word", F.col("word") - F.col("apart"))
    return found.select(*copies.columns).unionByName(copies).select(
        "doc_id",
        F.col("line").alias("paragraph"),
        "word",
        "n_words",
        F.col("of").alias("kept_doc_id"),
        F.col("of_line").alias("kept_paragraph"),
        F.col("of_word").alias("kept_word"),
    )
