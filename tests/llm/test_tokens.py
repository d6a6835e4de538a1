"""Token files, packing and language-model scores."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import documents, empty, rows, texts

from pyspark.sql import functions as F

from shelfdiff.llm import attention_lm, dac, packing, tokens, words

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.default_path())


def library_ids(encoder, text):
    return np.array(encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4")


def test_ids_equal_those_of_the_library(encoder):
    r = random.Random(0)
    letters = [chr(i) for i in range(1, 0x180)] + ["́", " ", "中", "\U0001f642", "<|endoftext|>"]
    odd = ["".join(r.choice(letters if r.random() < 0.5 else list("ab 's't.9")) for _ in range(9)) for _ in range(3000)]
    for text in [*odd, *texts(), *(x[1] for x in rows())]:
        assert encoder.ids(text) == library_ids(encoder, text).tobytes()


@pytest.mark.parametrize("high", [1, 200, 60_000, 2**32 - 1])
def test_code_files_give_every_id_back(high):
    ids = np.random.default_rng(high).integers(0, high, 3000, dtype=np.uint64).astype(np.uint32)
    starts = np.array([0, 0, 7, 2999, 3000])
    file = dac.DacFile(dac.dump(np.array([5, dac.NO_DOC, 9, 9]), starts, ids))
    assert [file[i] for i in range(3000)] == ids.tolist()
    assert all((file.document(k) == ids[starts[k] : starts[k + 1]]).all() for k in range(4))
    with pytest.raises(IndexError):
        file[3000]


def test_written_ids_are_read_back(spark, encoder):
    files = dac.write_ids(documents(spark), file_ids=500)
    got = dac.read_documents(files).collect()
    assert files.count() > 3
    data = sorted(rows(), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    got.sort(key=lambda x: x.start)
    assert len(got) == len(data)
    start = 0
    for x, (doc_id, text, *_) in zip(got, data, strict=True):
        ids = np.append(library_ids(encoder, text), dac.END_ID).astype("<u4")
        assert (x.doc_id, x.start, x.n_tokens, x.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert dac.read_documents(dac.write_ids(empty(spark))).count() == 0


@pytest.mark.parametrize("capacity, groups, small", [(64, 2048, None), (64, 5, 10), (300, 3, 0), (16, 4, 16)])
def test_packing_is_gapless_and_whole(spark, encoder, capacity, groups, small):
    got = packing.pack(documents(spark), capacity=capacity, groups=groups, small=small).collect()
    by_text = Counter()
    for doc_id, text, *_ in rows():
        ids = np.append(library_ids(encoder, text), 1).astype("<u4")
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            by_text[doc_id, k // capacity, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == by_text
    bins = {}
    for x in got:
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(x.length for x in got)
    if groups > 100:
        assert len(bins) <= 1.03 * math.ceil(total / capacity) + 1


def test_packing_nothing(spark):
    assert packing.pack(empty(spark)).count() == 0


def test_configurations_fill_best():
    r = random.Random(3)
    for _ in range(200):
        sizes = sorted({r.randint(3, 20) for _ in range(5)}, reverse=True)
        left = [r.randint(0, 3) for _ in sizes]
        left[0] += 1
        config = packing.best_configuration(sizes, left, 0, 40)
        assert config[0] >= 1 and all(n <= left[g] for g, n in config.items())
        fill = {sizes[0]}
        for g, size in enumerate(sizes):
            for _ in range(left[g] - (g == 0)):
                fill |= {x + size for x in fill if x + size <= 40}
        assert sum(sizes[g] * n for g, n in config.items()) == max(x for x in fill if x <= 40)


def fold():
    return F.crc32(F.col("doc_id").cast("string")) % 5 != 1


@pytest.mark.parametrize("max_frequent", [400_000, 30, 0])
def test_base_scores_equal_plain_counts(spark, max_frequent):
    docs = documents(spark)
    got = attention_lm.scores(docs, fold(), max_frequent=max_frequent, steps=20).collect()
    assert len(got) == len(rows())
    split = lambda t: [*words.lower_words(t), b"\n"]
    count = Counter()
    for i, t, *_ in rows():
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(split(t))
    total, distinct = sum(count.values()), len(count)
    log = lambda w: math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1)))
    expected = sorted((i is None, i or 0, len(split(t)), sum(count[w] > 0 for w in split(t)), round(sum(map(log, split(t))), 6)) for i, t, *_ in rows())
    assert sorted((x.doc_id is None, x.doc_id or 0, x.n_tokens, x.n_known, round(x.base_score, 6)) for x in got) == expected
    assert {x.train_tokens for x in got} == {total}
    assert all(math.isfinite(x.score) for x in got)


def test_nothing_to_learn_from_or_to_score(spark):
    docs = documents(spark)
    assert attention_lm.scores(empty(spark), F.lit(True)).count() == 0
    got = attention_lm.scores(docs, F.lit(False)).collect()
    assert len(got) == len(rows()) and {x.n_known for x in got} == {0}
    assert all(x.score == x.base_score for x in got)


@pytest.mark.parametrize("docs_per_bag", [200_000, 30])
def test_scores_are_logs_of_a_distribution(spark, docs_per_bag):
    """At every place the chances of all training words and of an unknown one sum to one,
    and the scores are the sums of their logs."""
    docs = documents(spark)
    options = {"steps": 20, "max_docs": 20, "docs_per_bag": docs_per_bag}
    model, known, counts = attention_lm.fit(docs.filter(fold()), tokens.default_path(), max_frequent=40, **options)
    n = {bytes(x.word): x.n for x in counts.collect()}
    index = {w: i for i, w in enumerate(n)}
    subwords = attention_lm.Subwords(tokens.default_path())
    ratios = model.ratios(subwords.flat(list(n))).astype(float)
    z = known.total + 0.5 * (known.distinct + 1)
    share = (np.array(list(n.values())) + 0.5) / z
    scorer = attention_lm.Scorer(model, known, subwords)
    expected = []
    for i, t, *_ in rows():
        own = attention_lm._split(t)
        gates = np.exp(scorer.gates(scorer.rows(own), np.array([len(own)])).astype(float))
        chance = gates @ ratios.T * share
        assert np.abs(chance.sum(1) + 0.5 / z - 1).max() < 1e-6
        found = [chance[j, index[w]] if w in index else 0.5 / z for j, w in enumerate(own)]
        expected.append((i is None, i or 0, float(np.log10(found).sum())))
    got = attention_lm.scores(docs, fold(), max_frequent=40, **options).collect()
    got = sorted((x.doc_id is None, x.doc_id or 0, x.score) for x in got)
    assert [g[:2] for g in got] == [e[:2] for e in sorted(expected)]
    assert np.allclose([g[2] for g in got], [e[2] for e in sorted(expected)], rtol=1e-4, atol=1e-3)


def test_windows_do_not_see_what_follows():
    """A change in a text leaves all gates before it as they were."""
    subwords = attention_lm.Subwords(tokens.default_path())
    tables, prior = attention_lm.expert_tables(np.zeros((attention_lm.EXPERTS, 3, subwords.size)))
    model = attention_lm.Model(tables, prior, np.ones(attention_lm.EXPERTS, np.float32), {})
    model.layer = attention_lm.train(model, [attention_lm._split(t) for t in texts(1, 30)], subwords, steps=5)
    scorer = attention_lm.Scorer(model, attention_lm.Counts(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0), subwords)
    one = [w for t in texts(2, 8) for w in attention_lm._split(t)]
    two = [*one[:90], *one[91:130], b"other", *one[130:]]
    gates = [scorer.gates(scorer.rows(t), np.array([len(t)])) for t in (one, two)]
    assert np.allclose(gates[0][:91], gates[1][:91], atol=1e-5)
    assert not np.allclose(gates[0][91:], gates[1][91 : len(one)], atol=1e-5)


def test_scores_do_not_depend_on_what_is_cached(monkeypatch):
    subwords = attention_lm.Subwords(tokens.default_path())
    total = np.random.default_rng(3).integers(0, 3, (attention_lm.EXPERTS, 3, subwords.size)).astype(float)
    tables, prior = attention_lm.expert_tables(total)
    model = attention_lm.Model(tables, prior, np.ones(attention_lm.EXPERTS, np.float32), {})
    model.layer = attention_lm.train(model, [attention_lm._split(t) for t in texts(1, 30)], subwords, steps=5)
    hashes = np.sort(words.word_hashes(list(dict.fromkeys(w for t in texts(1, 30) for w in t.encode().split()))))
    counts = attention_lm.Counts(hashes, np.arange(1, len(hashes) + 1), 10_000, len(hashes))
    whole = attention_lm.Scorer(model, counts, subwords)
    expected = [whole.score([t])[0] for t in texts(1, 40)]
    monkeypatch.setattr(attention_lm, "CACHE_WORDS", 60)
    small = attention_lm.Scorer(model, counts, subwords)
    got = [small.score([t])[0] for t in texts(1, 40)]
    assert len(small.index) < len(whole.index)
    for g, e in zip(got, expected, strict=True):
        assert g[:2] == e[:2] and np.allclose(g[2:4], e[2:4], rtol=1e-5)
        assert (g[4] == e[4]).all() and np.allclose(g[5], e[5], atol=1e-4)


def test_the_layer_learns_from_all_training_texts(spark):
    data = list(enumerate(texts(9, 60)))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    options = {"steps": 1, "max_docs": 5, "docs_per_bag": 12}
    model, known, _ = attention_lm.fit(docs, tokens.default_path(), **options)
    subwords = attention_lm.Subwords(tokens.default_path())
    start = attention_lm.train(model, [], subwords)
    ids = np.unique(np.concatenate([subwords.flat(attention_lm._split(t))[0] for _, t in data]))
    ids = ids[ids < subwords.end]
    assert (model.layer["e"][ids] != start["e"][ids]).any(1).all()
