"""Near copies, repeated paragraphs and components against plain loops."""

import random
from collections import defaultdict

import pytest
from llm_data import documents, edited, empty, rows, sentence, texts, word

from shelfdiff.llm import forest, paragraphs, words
from shelfdiff.llm.components import components


def shingle_set(text):
    w = words.lower_words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def clusters(sets: dict) -> dict:
    """The least key reachable by links of 75 %, of every key."""
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in keys}


def near_table(spark, group=70):
    """A dense group of variants of one text, beside others."""
    base = texts(3, 1)[0] + " " + sentence(random.Random(4), 120)
    out = [(1000 + i, edited(base, i, i % 14)) for i in range(group)]
    out += list(enumerate(texts(5, 40)))
    return out, spark.createDataFrame(out, "doc_id long, text string").repartition(4)


def test_near_duplicates_of_a_dense_group(spark):
    data, docs = near_table(spark)
    expected = clusters({i: shingle_set(t) for i, t in data})
    got = {r.doc_id: r for r in forest.near_duplicates(docs).collect()}
    assert {i: r.component_id for i, r in got.items()} == expected
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingle_set(t)) for i, t in data}


def test_near_duplicates_of_awkward_rows(spark):
    found = forest.near_duplicates(documents(spark)).collect()
    assert len(found) == len(rows())
    by_id = {r.doc_id: r for r in found}
    assert {by_id[i].component_id for i in (0, 100, 101)} == {0}
    assert by_id[102].component_id == 1 and by_id[107].component_id == 106
    assert by_id[109].component_id == 108
    for i in (103, 104, 105):
        assert (by_id[i].component_id, by_id[i].n_shingles, by_id[i].kept) == (i, 0, True)
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)


def test_one_of_each_group_stays(spark):
    kept = forest.keep_one(documents(spark)).collect()
    ids = [r.doc_id for r in kept]
    assert not {100, 101, 102, 107, 109} & set(ids)
    assert {0, 1, 103, 104, 105, 106, 108, 110} <= set(ids)
    assert ids.count(5) == 1
    assert kept[0].__fields__ == documents(spark).columns


def test_no_documents(spark):
    assert forest.near_duplicates(empty(spark)).count() == 0
    assert forest.keep_one(empty(spark)).count() == 0
    assert paragraphs.find_repeats(empty(spark)).count() == 0


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (129, 101)]
    table = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(table).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


@pytest.mark.parametrize("similarity", [0.75, 0.9])
def test_bands_reach_their_recall(similarity):
    n, size = paragraphs.bands(similarity, 0.999)
    assert 1 - (1 - similarity**size) ** n >= 0.999 and n * size <= 24


def test_repeated_paragraphs_equal_a_loop(spark):
    r = random.Random(2)
    shared = [sentence(r, n) for n in (60, 80, 30)]
    dense = sentence(r, 70)
    data = []
    for i in range(60):
        parts = [sentence(r, r.randint(5, 50)) for _ in range(3)]
        parts.insert(r.randint(0, 3), edited(shared[i % 3], i, i % 4))
        parts.append(edited(dense, i, i % 9))
        data.append((i, "\n".join(parts)))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    sets = {}
    for i, text in data:
        for k, line in enumerate(text.split("\n")):
            if len(line.split()) >= paragraphs.MIN_WORDS:
                sets[i, k] = shingle_set(line)
    expected = {k: v for k, v in clusters(sets).items() if k != v}
    got = {(x.doc_id, x.paragraph): (x.kept_doc_id, x.kept_paragraph) for x in paragraphs.find_repeats(docs).collect()}
    assert got == expected
    cleaned = {x.doc_id: x.text for x in paragraphs.remove_repeats(docs).collect()}
    gone = defaultdict(set)
    for i, k in expected:
        gone[i].add(k)
    assert cleaned == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in data}


def test_repeated_paragraphs_of_awkward_rows(spark):
    found = paragraphs.find_repeats(documents(spark)).collect()
    pairs = {(r.doc_id, r.kept_doc_id) for r in found}
    assert {(102, 1), (109, 108), (7, None)} <= pairs
    assert not {103, 104, 105, 106} & {i for i, _ in pairs}
    assert paragraphs.remove_repeats(documents(spark)).count() == len(rows())


def test_passages_equal_a_loop(spark):
    r = random.Random(8)
    inner, short = sentence(r, 57).split(" "), sentence(r, 66).split(" ")
    data = [(None, sentence(r, 120)), (-1, ""), (-2, None), (-3, sentence(r, 49))]
    for i in range(12):
        # Inside one long line; over several short ones; a copy of either within one text.
        line = sentence(r, 40 + i).split(" ") + inner[: 49 + i % 9] + sentence(r, 50).split(" ")
        step = 7 + i % 5
        lines = [" ".join(short[k : k + step]) for k in range(0, len(short), step)]
        data.append((i, "\n\n".join([sentence(r, 9), " ".join(line), *lines, sentence(r, 8 + i)])))
    data += [(20, "\n".join(["again " * 30] * 6)), (21, " ".join([*short, *short])), (22, data[0][1]), (5, data[9][1])]
    data.append((23, "\n \n" + data[8][1].upper()))
    seen, whole, expected = {}, {}, set()
    for i, text in sorted({d for d in data if d[1]}, key=lambda d: (d[0] is not None, d[0] or 0)):
        w = words.lower_words(text)
        for k in range(len(w) - paragraphs.RUN + 1):
            of, at = seen.setdefault(tuple(w[k : k + paragraphs.RUN]), (i, k))
            if whole.setdefault(tuple(w), i) != i:
                of, at = whole[tuple(w)], k
            if of != i or k - at >= paragraphs.RUN:
                expected.add((i, k, of, at))
    # The row of id 5 is there twice: a repeated row is the same place.
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    rows = paragraphs.find_passages(docs).collect()
    got = {
        (x.doc_id, x.word + k, x.kept_doc_id, x.kept_word + k)
        for x in rows
        for k in range(x.n_words - paragraphs.RUN + 1)
    }
    assert got == expected
    texts_of = dict([*data[4:16], data[-1]])
    for x in rows:
        if x.doc_id in texts_of and x.doc_id != 5:
            before = [len(line.split()) for line in texts_of[x.doc_id].split("\n")]
            assert x.doc_id != 23 or (x.paragraph, x.kept_paragraph, x.word) == (2, 0, 0)
            assert sum(before[: x.paragraph]) <= x.word < sum(before[: x.paragraph + 1])
    # Two texts that share one passage inside longer lines have no similar line.
    pair = spark.createDataFrame([d for d in data if d[0] in (7, 8)], "doc_id long, text string")
    assert paragraphs.find_repeats(pair).count() == 0 and paragraphs.find_passages(pair).count() == 2
    assert paragraphs.find_passages(empty(spark)).count() == 0


def halves(seed: int, each: int) -> list[str]:
    """Two dense groups of near copies that one pair of exactly 75 % holds together.

    All of a half agree in 97 % and more; the last text of the first half and the first of
    the second share 150 of 200 shingles in all."""
    r = random.Random(seed)
    shared = [f"s{seed}w{i}" for i in range(154)]
    out = []
    for half in range(2):
        # The bridge shares 150 shingles and has 25 of its own.
        bridge = [*shared, *(f"h{seed}x{half}y{i}" for i in range(25))]
        own = list(bridge)
        # The others of a half differ from the bridge at the shared end too.
        own[:3] = [f"z{seed}h{half}q{i}" for i in range(3)]
        rest = [[*own, *(word(r) for _ in range(r.randint(1, 2)))] for _ in range(each - 1)]
        out += [" ".join(w) for w in (bridge, *rest)]
    return out


@pytest.mark.parametrize("partitions", [1, 4, 53])
def test_one_link_between_dense_halves(spark, partitions):
    data = [(1000 * g + i, t) for g in range(6) for i, t in enumerate(halves(g, 200))]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(partitions)
    expected = clusters({i: shingle_set(t) for i, t in data[:400]})
    assert set(expected.values()) == {0}
    got = {x.doc_id: x.component_id for x in forest.near_duplicates(docs).collect()}
    assert got == {i: i // 1000 * 1000 for i, _ in data}


@pytest.mark.parametrize("partitions", [4, 53])
def test_one_link_between_dense_halves_of_paragraphs(spark, partitions):
    data = [(1000 * g + i, t) for g in range(6) for i, t in enumerate(halves(g, 200))]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(partitions)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {x.doc_id: x.kept_doc_id for x in paragraphs.find_repeats(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == {i: i // 1000 * 1000 for i, _ in data if i % 1000}
