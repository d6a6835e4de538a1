"""Many words at once: their subword ids, their numbers, their places in windows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from shelfdiff.llm import attention_lm, merges, tokens, words

CHARACTERS = "abcdefghij.,:;!?-_0123456789é'ßÉ<|x÷\x1c日" + "aeiouthn" * 8


def some_words(n=4_000):
    draw = random.Random(5)
    return [
        *("".join(draw.choices(CHARACTERS, k=draw.randint(1, 12))).encode().lower() for _ in range(n)),
        *(b"ab" * 40, b"aaaaaaaaaaaaaa", b"...", b"don't", b"<|endoftext|>", "é".encode(), b"\xc3\x97", attention_lm.END_WORD),
    ]


def test_ids_of_many_words_are_those_of_the_library():
    subwords = attention_lm.Subwords(tokens.default_path())
    some = some_words()
    library = subwords.encoder.tokenizer
    expected = [[subwords.end] if w == attention_lm.END_WORD else library.encode(w.decode(), add_special_tokens=False).ids for w in some]
    expected[some.index(b"<|endoftext|>")] = list(np.frombuffer(subwords.encoder.ids("<|endoftext|>"), "<u4"))
    ids, sizes = subwords.encode(pa.array(some, pa.binary()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == expected
    # Most of them were merged together, without the library.
    _, _, left = subwords.merges.find(*attention_lm._bytes(pa.array(some, pa.binary())))
    usual = [not set(w.decode()) & set("'<É÷\x1c日×\n") for w in some]
    assert not (left & np.array(usual) & (np.array([len(w) for w in some]) <= merges.MOST_BYTES)).any() and sum(usual) > 100


def test_a_tokenizer_without_known_steps_goes_through_the_library():
    subwords = attention_lm.Subwords(tokens.default_path())
    column = pa.array(some_words(200), pa.binary())
    ids, sizes = subwords.encode(column)
    subwords.merges = None
    plain, plain_sizes = subwords.encode(column)
    assert (ids == plain).all() and (sizes == plain_sizes).all()
    assert [len(x) for x in subwords.encode(pa.array([], pa.binary()))] == [0, 0]
    # A slice of a column begins inside its buffers.
    part, _ = subwords.encode(column.slice(7, 50))
    assert (part == ids[sizes[:7].sum() : sizes[:57].sum()]).all()


def test_hashes_are_numbered_in_the_order_in_which_they_come():
    index, expected = attention_lm.HashRows(), {}
    draw = np.random.default_rng(2)
    for _ in range(20):
        every = draw.integers(0, 300, 50).astype(np.uint64) * np.uint64(2**57 + 1)
        some, first, of = np.unique(every, return_index=True, return_inverse=True)
        own, new = index.add(some, first)
        fresh = [h for h in dict.fromkeys(every.tolist()) if h not in expected]
        assert every[first[new]].tolist() == fresh
        for h in every.tolist():
            expected.setdefault(h, len(expected))
        assert own[of].tolist() == [expected[h] for h in every.tolist()]
    kept = np.arange(0, len(index), 3)
    names = list(expected)
    index.keep(kept)
    some = np.sort(np.array([names[i] for i in kept], np.uint64))
    own, new = index.add(some, np.arange(len(some)))
    assert not len(new) and [names[kept[i]] for i in own] == some.tolist()


@pytest.mark.parametrize("longest", [1, 5, 30])
def test_sums_of_runs_are_those_of_reduceat(longest):
    draw = np.random.default_rng(longest)
    table = draw.standard_normal((50, 16)).astype(np.float32)
    sizes = draw.integers(1, longest + 1, 200)
    which, starts = draw.integers(0, 50, sizes.sum()), np.cumsum(sizes) - sizes
    assert (attention_lm._sums(table, which, starts) == np.add.reduceat(table[which], starts, axis=0)).all()


def test_places_after_the_context_are_weighed_as_in_whole_windows():
    draw = np.random.default_rng(4)
    width, experts, window, lead = attention_lm.WIDTH, attention_lm.EXPERTS + 1, attention_lm.WINDOW, attention_lm.LEAD
    shapes = {n: (width, width) for n in "qkvx"} | {"b": (width,), "r": (window,), "u": (width, experts), "c": (experts,)}
    layer = {n: (draw.standard_normal(s) * 0.3).astype(np.float32) for n, s in shapes.items()}
    x = draw.standard_normal((9, window, width)).astype(np.float32)
    whole, _ = attention_lm.forward(layer, x)
    part, _ = attention_lm._forward(layer, x, lead)
    assert np.allclose(part, whole[:, lead:], atol=1e-6)


def test_every_word_of_all_texts_is_weighed_once():
    subwords = attention_lm.Subwords(tokens.default_path())
    tables, prior = attention_lm.expert_tables(np.zeros((attention_lm.EXPERTS, 3, subwords.size)))
    model = attention_lm.Model(tables, prior, np.ones(attention_lm.EXPERTS, np.float32), {})
    model.layer = attention_lm.train(model, [], subwords)
    counts = attention_lm.Counts(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0)
    scorer = attention_lm.Scorer(model, counts, subwords)
    draw = random.Random(1)
    texts = [" ".join(draw.choices(["one", "two", "three", "four"], k=n)) for n in (0, 1, 7, 8, 23, 24, 31, 32, 33, 56, 57, 200)]
    own = [attention_lm._split(t) for t in texts]
    rows, sizes = scorer.rows([w for t in own for w in t]), np.array([len(t) for t in own])
    places = np.concatenate([p for p, _ in scorer.windows(rows, sizes)])
    assert sorted(places.tolist()) == list(range(len(rows)))
    assert words.word_hashes([w for t in own for w in t]).tolist() == scorer.hashes[rows].tolist()
