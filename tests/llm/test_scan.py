"""Words, lines and hashes found in the bytes of texts against plain splitting."""

import numpy as np
import pyarrow as pa
import pytest

from shelfdiff.llm import attention_lm, paragraphs, tokens, words
from llm_data import rows

LONG = "x" * 70
AWKWARD = [None, "", " ", "\n", "One", "one", "a\n\nB c\n", "\x0b\x1c A\tb\r\nc", "Äé Zä", "no end", "ab ba", f"{LONG}a {LONG}b {LONG}A", "\n tail "]
AWKWARD.append(" ".join("Qwertyuiopasdfghjklz\xe9x"[k:n] for n in range(1, 23) for k in range(0, n, 3)))


def columns():
    texts = [*AWKWARD, *[t for _, t, *_ in rows()], None]
    yield texts, pa.array(texts, pa.string())
    yield texts, pa.array(texts, pa.large_string())
    yield texts[2:9], pa.array(texts, pa.string()).slice(2, 7)
    yield [], pa.array([], pa.string())
    yield [None], pa.array([None], pa.string())


@pytest.mark.parametrize("at_once", [100_000, 3])
def test_scanned_words_and_lines_equal_plain_splitting(monkeypatch, at_once):
    monkeypatch.setattr(words, "_WORDS_AT_ONCE", at_once)
    for texts, column in columns():
        scan = words.Texts(column)
        split = [words.lower_words(t) for t in texts]
        every = [w for s in split for w in s]
        assert np.diff(scan.first).tolist() == [len(s) for s in split]
        assert scan.names(np.arange(len(every))).to_pylist() == every
        assert scan.hashes().tolist() == words.word_hashes(every).tolist()
        starts, ends, first = scan.lines()
        lines = [line.split() for t in texts for line in (t or "").encode().lower().split(b"\n")]
        assert [every[s:e] for s, e in zip(starts, ends, strict=True)] == lines
        assert np.diff(first).tolist() == [(t or "").count("\n") + 1 for t in texts]


def test_paragraphs_of_many_texts_are_those_of_each_alone():
    texts = [t for _, t, *_ in rows()]
    of, place, n, digests, keys = paragraphs._digests(words.Texts(pa.array(texts, pa.string())), 5)
    together = list(zip(of.tolist(), place.tolist(), n.tolist(), digests, keys.tolist(), strict=True))
    alone = []
    for i, t in enumerate(texts):
        _, place, n, digests, keys = paragraphs._digests(words.Texts(pa.array([t], pa.string())), 5)
        alone += [(i, *x) for x in zip(place.tolist(), n.tolist(), digests, keys.tolist(), strict=True)]
        lines = [line.split() for line in (t or "").split("\n")] if (t or "").isascii() else None
        if lines is not None and "\x1c" not in (t or ""):
            assert [x[1:3] for x in alone if x[0] == i] == [(k, len(x)) for k, x in enumerate(lines) if len(x) >= 5]
    assert together == alone and together


def test_a_column_of_texts_trains_the_layer_as_lists_of_words_do():
    subwords = attention_lm.Subwords(tokens.default_path())
    tables, prior = attention_lm.expert_tables(np.zeros((attention_lm.EXPERTS, 3, subwords.size)))
    model = attention_lm.Model(tables, prior, np.ones(attention_lm.EXPERTS, np.float32), {})
    texts = [*AWKWARD, *[t for _, t, *_ in rows()]] * 12
    column = pa.array(texts, pa.string())
    split = attention_lm.Split(column)
    expected = [attention_lm._split(t) for t in texts]
    assert split.sizes.tolist() == [len(t) for t in expected]
    assert split.names(np.arange(len(split.hashes))).to_pylist() == [w for t in expected for w in t]
    assert split.hashes.tolist() == words.word_hashes([w for t in expected for w in t]).tolist()
    own = attention_lm.train(model, expected, subwords, steps=5)
    got = attention_lm.train_column(model, column, subwords, steps=5)
    assert all((own[n] == got[n]).all() for n in own)


def test_slopes_of_the_layer_are_those_of_its_loss():
    r = np.random.default_rng(5)
    width, experts, window = attention_lm.WIDTH, attention_lm.EXPERTS + 1, attention_lm.WINDOW
    shapes = {"q": (width, width), "k": (width, width), "v": (width, width), "x": (width, width), "b": (width,)}
    shapes |= {"r": (window,), "u": (width, experts), "c": (experts,)}
    layer = {n: r.standard_normal(s) * 0.3 for n, s in shapes.items()}
    x, logs = r.standard_normal((3, window, width)), r.standard_normal((3, window, experts))
    real = (r.random((3, window)) < 0.8).astype(float)

    def loss():
        gates, _ = attention_lm.forward(layer, x)
        return -(np.log(np.exp(gates + logs).sum(-1)) * real).sum() / real.sum()

    gates, made = attention_lm.forward(layer, x)
    grads, dx = attention_lm._gradients(layer, x, made, gates, logs, real)
    for values, slope in [*((layer[n], grads[n]) for n in layer), (x, dx)]:
        at = tuple(r.integers(n) for n in values.shape)
        was, found = values[at], []
        for step in (1e-5, -1e-5):
            values[at] = was + step
            found.append(loss())
        values[at] = was
        assert abs((found[0] - found[1]) / 2e-5 - slope[at]) < 1e-6


def test_equal_keys_are_grouped_in_their_order():
    for top in (5, 100_000):
        keys = np.random.default_rng(1).integers(0, top, 300).astype(np.int32)
        order, first = attention_lm._grouped(keys)
        some, of = np.unique(keys, return_inverse=True)
        assert (keys[order[first]] == some).all() and (order == np.argsort(of, kind="stable")).all()
