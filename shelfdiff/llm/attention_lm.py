"""Language-model scores by causal self-attention over words read as subword ids.

A text is its words in lower case (A-Z), then an end. The model predicts each from those
before it. One layer of masked self-attention, with learnt weights for distance, reads the
words through embeddings of their subword ids and weighs several experts, each of them a
distribution over words:

* every training text belongs to the nearest of some centres. Spark counts the words of
  all of them by cluster, and from these the ids; the smoothed counts of ids in a cluster
  tell how likely a word, read id by id, comes of that kind of text. An expert's chance of
  a word is the word's smoothed share of the training corpus times that likelihood, over
  the mean of the likelihood by share, which is summed over all distinct training words;
* the last expert is the plain share itself.

So every expert, and any mixture of them, is a distribution over the words of the training
texts and one more outcome, a word that none of them has. The score of a text is the sum
of the logs of its words' shares, plus a gain by subword ids and context; words that no
training text has gain nothing.

The attention layer and its embeddings learn from all training texts: these are dealt to
hash buckets of about `DOCS_PER_BAG` documents, a task trains on each bucket in numpy, with
Adam, every window of it at least once, and the parameters, which start alike, are
averaged. The centres start as those of `MAX_DOCS` texts of the first bucket and move to the means of all
training texts nearest to them. Scoring covers every text: it is cut into overlapping windows, `LEAD` words
of context to each but the first, so that every word is scored once; the windows of many
texts go through attention together.

Counts of the most frequent words (`MAX_FREQUENT` at most) are broadcast. All others meet
their counts in a join.

Defined cases: null and empty texts have the end alone; without any training text the
counts are zero and nothing is gained; repeated rows are scored each, and train the layer
once; a null document id is scored and belongs to no training text (a condition on it is
null); an empty table gives an empty result. Other
columns are ignored. Words are told apart by 64 bits of a hash.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm import merges, tokens, words
from shelfdiff.session import settle, ship

EXPERTS = 12
WIDTH = 16
WINDOW = 32
LEAD = 8
MAX_DOCS = 2_000
DOCS_PER_BAG = 5_000
BINS = 2048
MAX_FREQUENT = 400_000
STEPS = 500
BATCH = 128
RATE = 0.02
SMOOTH = 50.0
CACHE_WORDS = 300_000
LN10 = float(np.log(10))

# The end of a text counts as a word; this hash stands for it.
END_WORD = b"\n"
_START, _INNER, _FINAL = 0, 1, 2  # before a word's first id, and after one that goes on or ends


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and the sizes of its values."""
    if not len(column):
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset)
    lo, hi = int(bounds[0]), int(bounds[-1])
    return np.frombuffer(data, np.uint8, hi - lo, lo) if hi > lo else np.empty(0, np.uint8), np.diff(bounds).astype(np.int64)


class Subwords:
    """The ids of words; the last two numbers stand for the end of a text and its start,
    and `stop` ends a word's ids."""

    def __init__(self, path: str):
        self.encoder = tokens.encoder(path)
        self.merges = _merges(path)
        vocabulary = self.encoder.tokenizer.get_vocab()
        n = max(vocabulary.values()) + 1
        self.end, self.begin, self.stop, self.size = n, n + 1, n + 2, n + 3
        self.final = np.zeros(self.size, bool)
        self.final[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.final[self.end] = True

    def ids(self, word: bytes) -> bytes:
        if word == END_WORD:
            return self.end.to_bytes(4, "little")
        return self.encoder.word_ids(word)

    def encode(self, some: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column of words, one after another, and how many each has."""
        data, sizes = _bytes(some)
        if self.merges is None:
            found = np.empty(0, np.int32), np.zeros(len(some), np.int64), np.ones(len(some), bool)
        else:
            found = self.merges.find(data, sizes)
        left = some.take(pa.array(np.flatnonzero(found[2]))).to_pylist()
        return merges.together(found, [self.ids(w) for w in left])

    def flat(self, some: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words with a stop after each, the state before every id, and where
        each word begins."""
        return self.lay(*self.encode(some if isinstance(some, pa.Array) else pa.array(some, pa.binary())))

    def lay(self, found: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What `flat` gives, for words whose ids are given."""
        sizes = sizes + 1
        starts = np.cumsum(sizes) - sizes
        ids = np.full(int(sizes.sum()), self.stop, np.int64)
        inner = np.ones(len(ids), bool)
        inner[starts + sizes - 1] = False
        ids[inner] = found
        states = np.full(len(ids), _INNER)
        states[1:][self.final.take(ids[:-1])] = _FINAL
        states[starts] = _START
        return ids, states, starts

    def lay_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What `flat` gives, for a column of ids without nulls."""
        data, sizes = _bytes(column)
        return self.lay(data.view("<u4"), sizes // 4)


_MERGES: dict[str, merges.Merges | None] = {}


def _merges(path: str) -> merges.Merges | None:
    """The merges of this worker process, for tokenizers whose first steps are known."""
    if path not in _MERGES:
        encoder = tokens.encoder(path)
        _MERGES[path] = merges.read(path, encoder.characters) if encoder.known_steps else None
    return _MERGES[path]


@dataclass
class Model:
    """`tables`: by state and id, the log chance in each cluster; `prior` the logs of the
    clusters' shares of the corpus; the rest is the attention layer."""

    tables: np.ndarray
    prior: np.ndarray
    scale: np.ndarray
    layer: dict[str, np.ndarray]

    def ratios(self, flat: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """How much likelier words are under each expert than by their share."""
        out = _posterior(self.tables, self.prior, flat) / self.scale
        return np.concatenate([out, np.ones((len(out), 1), np.float32)], axis=1)


def _split(text: str | None) -> list[bytes]:
    return [*words.lower_words(text), END_WORD]


class Split:
    """The words of a column of texts with an end after each: `sizes` of the texts and the
    `hashes` of all their words."""

    def __init__(self, column: pa.Array):
        self.texts = words.Texts(column)
        ends = self.texts.first[1:]
        self.sizes = np.diff(self.texts.first) + 1
        self.hashes = np.insert(self.texts.hashes(), ends, words.word_hashes([END_WORD]))
        self.word = np.insert(np.arange(len(self.texts.starts)), ends, -1)

    def names(self, places: np.ndarray) -> pa.Array:
        """The words at some places."""
        word = self.word[places]
        inner = word >= 0
        found = pa.concat_arrays([self.texts.names(word[inner]), pa.array([END_WORD], pa.binary())])
        return found.take(pa.array(np.where(inner, np.cumsum(inner) - 1, len(found) - 1)))


def _column(texts: pd.Series) -> pa.Array:
    return pa.array(texts, pa.string(), from_pandas=True)


def _bins(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Texts, one after another, as unit vectors of their words' logged counts in bins."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = text * BINS + (hashes % np.uint64(BINS)).astype(np.int64)
    counts = np.bincount(place, minlength=len(sizes) * BINS)
    logs = np.log1p(np.arange(counts.max(initial=0) + 1)).astype(np.float32)
    x = logs.take(counts).reshape(-1, BINS)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), np.float32(1e-9))


def cluster_centres(texts: list[list[bytes]], k: int = EXPERTS, rounds: int = 12) -> np.ndarray:
    """Spherical k-means with far-apart first centres; a row for each centre."""
    if not texts:
        return np.zeros((k, BINS), np.float32)
    x = _bins(words.word_hashes([w for t in texts for w in t]), np.array([len(t) for t in texts]))
    centres = [x.mean(0)]
    while len(centres) <= k:
        near = np.max(np.stack([x @ c / max(np.linalg.norm(c), 1e-9) for c in centres]), 0)
        centres.append(x[int(np.argmin(near))])
    centre = np.stack(centres[1:])
    for _ in range(rounds):
        mine = np.argmax(x @ centre.T, axis=1)
        for c in range(k):
            if (mine == c).any():
                mean = x[mine == c].mean(0)
                centre[c] = mean / max(np.linalg.norm(mean), 1e-9)
    return centre


def expert_tables(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From counts by cluster, state and id: smoothed log chances of ids by state, one
    column per cluster, and the logs of the clusters' shares."""
    every = total.sum(0) + 0.02
    every /= every.sum(1, keepdims=True)
    found = (total + SMOOTH * every) / (total.sum(2, keepdims=True) + SMOOTH)
    share = total.sum((1, 2)) + 1
    tables = np.ascontiguousarray(np.log(found).transpose(1, 2, 0), np.float32)
    return tables, np.log(share / share.sum()).astype(np.float32)


def _posterior(tables: np.ndarray, prior: np.ndarray, flat: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The chance of each cluster, given a word's ids."""
    ids, states, starts = flat
    places = states * tables.shape[1] + ids
    logs = np.add.reduceat(tables.reshape(-1, tables.shape[2]).take(places, axis=0), starts, axis=0) + prior
    logs -= logs.max(1, keepdims=True)
    np.exp(logs, out=logs)
    return logs / logs.sum(1, keepdims=True)


def word_vectors(embedding: np.ndarray, flat: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The mean embedding of each word's ids, stop included."""
    ids, _, starts = flat
    sizes = np.diff(np.append(starts, len(ids)))
    return np.add.reduceat(embedding.take(ids, axis=0), starts, axis=0) / sizes[:, None].astype(np.float32)


_MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)
_DISTANCE = np.clip(np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :], 0, None)


def _flat(x: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1])


def _times(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """x @ weights, the places of all windows in one product."""
    return (_flat(x) @ weights).reshape(*x.shape[:-1], -1)


def _sum_rows(x: np.ndarray) -> np.ndarray:
    """The sums of columns, added in the order in which numpy adds a short row."""
    if len(x) < 8:
        return x.sum(0)
    a, b, c, d, e, f, g, h = x[:8]
    total = ((a + b) + (c + d)) + ((e + f) + (g + h))
    for row in x[8:]:
        total += row
    return total


def forward(layer: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, dict]:
    """Log weights of the experts at each place of windows x (n, WINDOW, WIDTH), and what
    training needs."""
    return _forward(layer, x, 0)


def _forward(layer: dict[str, np.ndarray], x: np.ndarray, lead: int) -> tuple[np.ndarray, dict]:
    """What `forward` gives, of the places from `lead` on."""
    # The root of `WIDTH` is a power of two: queries may be scaled before their products.
    seen = np.ascontiguousarray(x[:, lead:]) if lead else x
    q = _times(seen, layer["q"] * np.float32(WIDTH**-0.5))
    k, v = (_times(x, layer[n]) for n in ("k", "v"))
    score = q @ k.transpose(0, 2, 1)
    score += (layer["r"][_DISTANCE] + _MASK)[lead:]
    score -= score.max(-1, keepdims=True)
    attention = np.exp(score, out=score)
    attention /= attention.sum(-1, keepdims=True)
    z = attention @ v
    z += _times(seen, layer["x"])
    z += layer["b"]
    h = np.tanh(z, out=z)
    # A row for each expert: sums over the last axis are slow when it is short.
    g = np.ascontiguousarray((_flat(h) @ layer["u"] + layer["c"]).T)
    g -= g.max(0)
    g -= np.log(_sum_rows(np.exp(g)))
    gates = g.reshape(-1, *z.shape[:2]).transpose(1, 2, 0)
    return gates, {"q": q, "k": k, "v": v, "a": attention, "h": h}


def _gradients(layer, x, made, gates, logs, real) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Of the mean negative log chance at `real` places: by parameter and by input."""
    by_expert = [np.ascontiguousarray(_flat(y).T) for y in (gates, logs)]
    chance = by_expert[0] + by_expert[1]
    chance -= chance.max(0)
    np.exp(chance, out=chance)
    chance /= _sum_rows(chance)
    dg = np.exp(by_expert[0])
    dg -= chance
    dg *= (real / real.sum()).ravel()
    dg = np.ascontiguousarray(dg.T).reshape(*gates.shape)
    dpre = _times(dg, layer["u"].T)
    dpre *= 1 - made["h"] ** 2
    dv = made["a"].transpose(0, 2, 1) @ dpre
    ds = dpre @ made["v"].transpose(0, 2, 1)
    ds -= (ds * made["a"]).sum(-1, keepdims=True)
    ds *= made["a"]
    dq, dk = ds @ made["k"], ds.transpose(0, 2, 1) @ made["q"]
    dq *= np.float32(WIDTH**-0.5)
    by_product = ("q", dq), ("k", dk), ("v", dv), ("x", dpre)
    grads = {name: _flat(x).T @ _flat(d) for name, d in by_product}
    grads["b"], grads["c"] = _flat(dpre).sum(0), _flat(dg).sum(0)
    grads["u"] = _flat(made["h"]).T @ _flat(dg)
    grads["r"] = np.bincount(_DISTANCE.ravel(), ds.sum(0).ravel(), WINDOW).astype(np.float32)
    dx = _times(dq, layer["q"].T)
    for name, d in by_product[1:]:
        dx += _times(d, layer[name].T)
    return grads, dx


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts equal keys, which are not negative, side by side, and where each
    group begins."""
    # Sorting is quicker for small numbers: by the low 16 bits, then by those above.
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    if len(keys) and keys.max() >= 2**32:
        order = np.argsort(keys, kind="stable")
    elif len(keys) and keys.max() >= 2**16:
        order = order.take(np.argsort((keys >> 16).astype(np.uint16).take(order), kind="stable"))
    return order, np.flatnonzero(np.diff(keys.take(order).astype(np.int64), prepend=-1))


def _sums(table: np.ndarray, which: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sums of the rows of a table that runs of numbers name, as `reduceat` adds them."""
    sizes = np.diff(starts, append=len(which))
    out = np.empty((len(starts), table.shape[1]), table.dtype)
    order = np.argsort(np.minimum(sizes, 9).astype(np.uint8), kind="stable")[::-1]
    left = np.bincount(np.minimum(sizes, 9), minlength=10)[::-1].cumsum()[::-1].tolist()
    long = order[: left[9]]
    if len(long):
        places, at = words.ranges(starts.take(long), sizes.take(long))
        out[long] = np.add.reduceat(table.take(which.take(places), axis=0), at, axis=0)
    # Of short runs, longer ones first, all rows but the first are added one by one.
    short = order[left[9] :]
    place = starts.take(short)
    sums = table.take(which.take(place), axis=0)
    rest = table.take(which.take(place[: left[2] - left[9]] + 1), axis=0)
    for k in range(2, 8):
        n = left[k + 1] - left[9]
        rest[:n] += table.take(which.take(place[:n] + k), axis=0)
    sums[: len(rest)] += rest
    out[short] = sums
    return out


def train(model: Model, texts: list[list[bytes]], subwords: Subwords, steps: int = STEPS) -> dict[str, np.ndarray]:
    """What `train_rows` gives, for texts as lists of words."""
    names = dict.fromkeys(w for t in texts for w in t)
    number = {w: i for i, w in enumerate(names)}
    rows = [np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts]
    sizes = np.array([len(r) for r in rows], np.int64)
    rows = np.concatenate([*rows, np.empty(0, np.int64)])
    return train_rows(model, pa.array(names, pa.binary()), rows, sizes, subwords, steps)


def train_column(model: Model, column: pa.Array, subwords: Subwords, steps: int = STEPS) -> dict[str, np.ndarray]:
    """What `train_rows` gives, for a column of texts."""
    # Words are known by their hashes; only numbers and one name of each word are held.
    index, names, rows, sizes = HashRows(), [pa.array([], pa.binary())], [], []
    for i in range(0, len(column), 500):
        split = Split(column[i : i + 500])
        some, first, of = np.unique(split.hashes, return_index=True, return_inverse=True)
        own, new = index.add(some, first)
        names.append(split.names(first[new]))
        rows.append(own.astype(np.int32).take(of))
        sizes.append(split.sizes)
    del index
    none = np.empty(0, np.int32)
    rows, sizes = np.concatenate([none, *rows]), np.concatenate([none, *sizes])
    return train_rows(model, pa.concat_arrays(names), rows, sizes, subwords, steps)


def train_rows(
    model: Model, names: pa.Array, rows: np.ndarray, sizes: np.ndarray, subwords: Subwords, steps: int = STEPS
) -> dict[str, np.ndarray]:
    """An attention layer that weighs the experts of `model`, by so many steps at least, and
    as many as it takes to see every window of the texts. These lie one after another in
    `rows`, numbers of words among `names`."""
    random = np.random.default_rng(7)
    draw = lambda *shape: (random.standard_normal(shape) * 0.1).astype(np.float32)
    layer = {n: draw(WIDTH, WIDTH) for n in ("q", "k", "v", "x")}
    layer |= {"b": np.zeros(WIDTH, np.float32), "r": np.zeros(WINDOW, np.float32)}
    layer |= {"u": draw(WIDTH, EXPERTS + 1), "c": np.zeros(EXPERTS + 1, np.float32)}
    layer["e"] = draw(subwords.size, WIDTH) * 3
    if not len(names):
        return layer
    begin = len(names)
    ids, lengths, logs = [], [], np.empty((begin, EXPERTS + 1), np.float32)
    for i in range(0, begin, 40_000):
        flat = subwords.flat(names[i : i + 40_000])
        ids.append(flat[0].astype(np.int32))
        lengths.append(np.diff(np.append(flat[2], len(flat[0]))))
        logs[i : i + 40_000] = np.log(model.ratios(flat) + np.float32(1e-20))
    ids, lengths = np.concatenate(ids), np.concatenate(lengths)
    starts = np.cumsum(lengths) - lengths
    # Every text follows its start; windows begin at every `WINDOW` words of it.
    lows = np.cumsum(sizes) - sizes
    rows = np.insert(rows, lows, begin)
    lo, _ = words.ranges(np.zeros(len(sizes), np.int64), -(-sizes // WINDOW))
    lo *= WINDOW
    text = np.repeat(np.arange(len(sizes)), -(-sizes // WINDOW))
    spans = (lows + np.arange(len(sizes)))[text] + lo
    filled = np.minimum(sizes[text] - lo, WINDOW)
    state = {n: (np.zeros_like(p), np.zeros_like(p)) for n, p in layer.items()}
    steps = max(steps, -(-len(spans) // BATCH))
    rounds = -(-steps * BATCH // len(spans))
    picks = np.concatenate([random.permutation(len(spans)) for _ in range(rounds)])
    for step in range(1, steps + 1):
        pick = picks[(step - 1) * BATCH : step * BATCH]
        inside = np.arange(WINDOW) < filled[pick][:, None]
        place = np.where(inside, spans[pick][:, None] + np.arange(WINDOW), 0)
        inputs = np.where(inside, rows.take(place), begin)
        targets = np.where(inside, rows.take(place + 1), 0)
        real = inside.astype(np.float32)
        flat = inputs.ravel()
        order, first = _grouped(flat)
        used = flat.take(order.take(first))
        where = np.empty(len(flat), np.int64)
        where[order] = np.repeat(np.arange(len(used)), np.diff(first, append=len(flat)))
        own = used[used < begin]
        has_begin = int(used[-1] == begin)
        own_ids, at = words.ranges(starts[own], lengths[own])
        flat = np.append(ids.take(own_ids), [subwords.begin] * has_begin)
        at = np.append(at, [len(own_ids)] * has_begin)
        sizes = np.append(lengths[own], [1] * has_begin)
        vectors = _sums(layer["e"], flat, at) / sizes[:, None].astype(np.float32)
        x = vectors.take(where, axis=0).reshape(BATCH, WINDOW, WIDTH)
        gates, made = forward(layer, x)
        grads, dx = _gradients(layer, x, made, gates, logs.take(targets, axis=0), real)
        by_word = np.add.reduceat(_flat(dx).take(order, axis=0), first, axis=0) / sizes[:, None].astype(np.float32)
        order, first = _grouped(flat)
        touched = flat.take(order.take(first))
        of = np.repeat(np.arange(len(sizes)), sizes)
        grads["e"] = np.add.reduceat(by_word.take(of.take(order), axis=0), first, axis=0)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for name, slope in grads.items():
            # Of the embeddings only those of the ids at hand move.
            if name == "e":
                first, second, own = (m.take(touched, axis=0) for m in (*state[name], layer[name]))
            else:
                (first, second), own = state[name], layer[name]
            change = slope - first
            change *= 0.1
            first += change
            change = np.multiply(slope, slope, out=change)
            change -= second
            change *= 0.01
            second += change
            move = first / (1 - 0.9**step)
            scale = np.divide(second, 1 - 0.99**step, out=change)
            np.sqrt(scale, out=scale)
            scale += 1e-8
            move /= scale
            move *= rate
            own -= move
            if name == "e":
                for held, new in zip((*state[name], layer[name]), (first, second, own), strict=True):
                    held[touched] = new
    return layer


@dataclass
class Counts:
    """Counts of frequent words (hashes ascending), and the totals of all words."""

    hashes: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Counts, -1 for words that are not among the frequent ones."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.counts[at], -1)

    def log(self, counts: np.ndarray) -> np.ndarray:
        return np.log((counts + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


CLUSTER_COUNTS = [f"c{k}" for k in range(EXPERTS)]


def count_words(texts: DataFrame, centres: np.ndarray) -> DataFrame:
    """hash, word and n of every word of the column `text`, the end included, and its
    counts in each cluster of texts, c0, c1..."""

    def counted(hashes: np.ndarray, names: pa.Array, cluster: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(hashes.view(np.int64)), names, pa.array(cluster.astype(np.int32)), pa.array(n)]
        return pa.record_batch(columns, ["hash", "word", "cluster", "n"])

    def keys(hashes: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        """A word's hash moved by its cluster: one sort finds equal pairs."""
        return hashes + cluster.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("words")
        held: list[tuple] = []
        size = 0

        def merged() -> tuple:
            hashes, cluster, n = (np.concatenate([h[i] for h in held]) for i in (0, 2, 3))
            names = pa.concat_arrays([h[1] for h in held])
            _, first, pair = np.unique(keys(hashes, cluster), return_index=True, return_inverse=True)
            n = np.bincount(pair, n).astype(np.int64)
            return hashes[first], names.take(pa.array(first)), cluster[first], n

        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                split = Split(batch["text"][i : i + 500])
                hashes, sizes = split.hashes, split.sizes
                cluster = np.repeat(np.argmax(_bins(hashes, sizes) @ centres.T, axis=1), sizes)
                _, first, n = np.unique(keys(hashes, cluster), return_index=True, return_counts=True)
                names = split.names(first)
                held.append((hashes[first], names, cluster[first], n))
                # Long words count for several.
                size += len(n) + names.nbytes // 64
                if size > 1_000_000:
                    held = [merged()]
                    size = len(held[0][3]) + held[0][1].nbytes // 64
                    if size > 500_000:
                        yield counted(*held.pop())
                        size = 0
        if held:
            yield counted(*merged())

    found = texts.select("text").mapInArrow(count, "hash long, word binary, cluster int, n long")
    own = [F.sum(F.when(F.col("cluster") == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(CLUSTER_COUNTS)]
    return found.groupBy("hash", "word").agg(F.sum("n").alias("n"), *own)


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 20_000):
            yield batch.slice(i, 20_000)


def with_ids(counts: DataFrame, path: str) -> DataFrame:
    """Counted words with their subword `ids`, so that each is encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("tokens")
        subwords = Subwords(path)
        for batch in _word_batches(batches):
            found, sizes = subwords.encode(batch["word"])
            offsets = np.cumsum([0, *(4 * sizes)]).astype(np.int32)
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(found.astype("<u4"))]
            ids = pa.Array.from_buffers(pa.binary(), len(sizes), buffers)
            yield pa.record_batch([*batch.columns, ids], [*batch.schema.names, "ids"])

    kinds = ["hash long", "word binary", "n long", *(f"{c} long" for c in CLUSTER_COUNTS), "ids binary"]
    return counts.mapInArrow(encode, ", ".join(kinds))


def id_counts(counts: DataFrame, path: str, size: int) -> np.ndarray:
    """Counts by cluster, state and id over all counted words. Tables have a place for each
    state and id of the tokenizer, however many words there are."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("tokens")
        subwords = Subwords(path)
        total = np.zeros((3 * subwords.size, EXPERTS))
        for batch in _word_batches(batches):
            ids, states, starts = subwords.lay_column(batch["ids"])
            own = np.stack([batch[c].to_numpy() for c in CLUSTER_COUNTS], axis=1)
            place = states * subwords.size + ids
            order = np.argsort(place, kind="stable")
            places, lo = np.unique(place[order], return_index=True)
            word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
            total[places] += np.add.reduceat(own[word[order]], lo, axis=0)
        used = np.flatnonzero(total.any(1))
        columns = [pa.array(total[used, k].astype(np.int64)) for k in range(EXPERTS)]
        yield pa.record_batch([pa.array(used.astype(np.int32)), *columns], ["place", *CLUSTER_COUNTS])

    schema = ", ".join(["place int", *(f"{c} long" for c in CLUSTER_COUNTS)])
    found = counts.select("ids", *CLUSTER_COUNTS).mapInArrow(add, schema)
    table = found.groupBy("place").agg(*(F.sum(c).alias(c) for c in CLUSTER_COUNTS)).toArrow()
    total = np.zeros((EXPERTS, 3 * size))
    for k, c in enumerate(CLUSTER_COUNTS):
        total[k, table["place"].to_numpy()] = table[c].to_numpy()
    return total.reshape(EXPERTS, 3, size)


def expert_scale(counts: DataFrame, path: str, tables: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """The mean of each expert's likelihood over all counted words, by their shares."""
    shared = counts.sparkSession.sparkContext.broadcast((tables, prior))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("tokens")
        subwords = Subwords(path)
        sums = np.zeros(EXPERTS + 1)
        for batch in _word_batches(batches):
            weight = batch["n"].to_numpy() + 0.5
            likely = _posterior(*shared.value, subwords.lay_column(batch["ids"]))
            sums += np.append(weight @ likely, weight.sum())
        yield pa.record_batch([pa.array([x]) for x in sums], [*CLUSTER_COUNTS, "n"])

    schema = ", ".join(f"{c} double" for c in [*CLUSTER_COUNTS, "n"])
    found = counts.select("ids", "n").mapInArrow(add, schema)
    sums = found.agg(*(F.sum(c).alias(c) for c in [*CLUSTER_COUNTS, "n"])).first()
    if not sums["n"]:
        return np.ones(EXPERTS)
    return np.maximum(np.array([sums[c] for c in CLUSTER_COUNTS]) / sums["n"], 1e-30)


def frequent_counts(counts: DataFrame, most: int = MAX_FREQUENT) -> Counts:
    """The counts of the words that occur at least 2**j times, for the least j that leaves
    at most `most` words; and the totals of all."""
    powers = [F.sum((F.col("n") >= 2**j).cast("long")).alias(f"p{j}") for j in range(50)]
    row = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), *powers).first()
    least = next(2**j for j in range(50) if (row[f"p{j}"] or 0) <= most)
    some = counts.filter(F.col("n") >= least).select("hash", "n").toArrow()
    hashes = some["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Counts(hashes[order], some["n"].to_numpy()[order], int(row.total or 0), int(row.distinct))


def _room(n: int) -> tuple[np.ndarray, ...]:
    shapes = (((n, WIDTH), np.float32), ((n, EXPERTS + 1), np.float32), (n, np.uint64), (n, np.int64), (n, np.int64))
    return tuple(np.zeros(shape, kind) for shape, kind in shapes)


class HashRows:
    """Numbers words by their hashes, in the order in which they first come."""

    def __init__(self):
        self.hashes, self.rows = np.empty(0, np.uint64), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def add(self, some: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of distinct hashes, which ascend, after adding those that are new, and
        which these are, in the order of `first`."""
        at = np.searchsorted(self.hashes, some)
        known = np.zeros(len(some), bool)
        inside = at < len(self)
        known[inside] = self.hashes.take(at[inside]) == some[inside]
        own = np.empty(len(some), np.int64)
        own[known] = self.rows.take(at[known])
        new = np.flatnonzero(~known)
        order = new[np.argsort(first[new])]
        own[order] = np.arange(len(self), len(self) + len(new))
        self.hashes, self.rows = np.insert(self.hashes, at[new], some[new]), np.insert(self.rows, at[new], own[new])
        return own, order

    def keep(self, rows: np.ndarray) -> None:
        """Keeps some rows, which ascend, and numbers them anew."""
        number = np.full(len(self), -1)
        number[rows] = np.arange(len(rows))
        own = number.take(self.rows)
        self.hashes, self.rows = self.hashes[own >= 0], own[own >= 0]


class Scorer:
    """Scores texts with a model, keeping what words need in arrays."""

    def __init__(self, model: Model, counts: Counts, subwords: Subwords):
        self.model, self.counts, self.subwords = model, counts, subwords
        self.begin_vector = model.layer["e"][subwords.begin]
        self.clear()

    def clear(self) -> None:
        self.index = HashRows()
        self.vectors, self.ratios, self.hashes, self.n, self.uses = _room(0)

    def forget(self) -> None:
        """Keeps the half of the words that were used most, lately above all."""
        size = len(self.index)
        keep = np.sort(np.argpartition(-self.uses[:size], CACHE_WORDS // 2)[: CACHE_WORDS // 2])
        self.index.keep(keep)
        for held in (self.vectors, self.ratios, self.hashes, self.n, self.uses):
            held[: len(keep)] = held[keep]
        self.uses //= 2
        self.uses[len(keep) :] = 0

    def rows(self, flat: list[bytes]) -> np.ndarray:
        """The rows of words, after adding those that are new."""
        return self.find(words.word_hashes(flat), lambda places: pa.array([flat[i] for i in places], pa.binary()))

    def find(self, every: np.ndarray, names: Callable[[np.ndarray], pa.Array]) -> np.ndarray:
        """The rows of words with these hashes; `names` gives the words at some places."""
        if len(self.index) > CACHE_WORDS:
            self.forget()
        some, first, of, uses = np.unique(every, return_index=True, return_inverse=True, return_counts=True)
        own, new = self.index.add(some, first)
        rows = own.take(of)
        fresh = first[new]
        if len(fresh):
            lo, hi = len(self.index) - len(fresh), len(self.index)
            if hi > len(self.n):
                held = self.vectors, self.ratios, self.hashes, self.n, self.uses
                room = _room(max(2 * hi, 50_000))
                for old, larger in zip(held, room, strict=True):
                    larger[:lo] = old[:lo]
                self.vectors, self.ratios, self.hashes, self.n, self.uses = room
            parts = self.subwords.flat(names(fresh))
            hashes = every[fresh]
            self.vectors[lo:hi] = word_vectors(self.model.layer["e"], parts)
            self.ratios[lo:hi] = self.model.ratios(parts)
            self.hashes[lo:hi] = hashes
            self.n[lo:hi] = self.counts.find(hashes)
        self.uses[own] += uses
        return rows

    def gates(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log weights of the experts at every word of texts that lie one after another."""
        out = np.empty((len(rows), EXPERTS + 1), np.float32)
        for places, gates in self.windows(rows, sizes):
            out[places] = gates
        return out

    def mixed(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How much likelier every word is than by its share."""
        out = np.empty(len(rows), np.float32)
        for places, gates in self.windows(rows, sizes):
            ratios = self.ratios.take(rows.take(places), axis=0)
            out[places] = np.einsum("ij,ij->i", np.exp(gates, out=gates), ratios)
        return out

    def windows(self, rows: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of words and the log weights of the experts there, each place once."""
        starts = np.cumsum(sizes) - sizes
        step = WINDOW - LEAD
        n = np.maximum(-(-(sizes - LEAD) // step), 1)
        lo, _ = words.ranges(np.zeros(len(sizes), np.int64), n)
        lo *= step
        text = np.repeat(np.arange(len(sizes)), n)
        # Of all windows but the first of a text the first places are context alone.
        for lead, of in (0, np.flatnonzero(lo == 0)), (LEAD, np.flatnonzero(lo > 0)):
            for i in range(0, len(of), 128):
                part = of[i : i + 128]
                # Input j of a window is the word before place lo + j; the start comes first.
                place = lo[part][:, None] + np.arange(WINDOW)
                inside = place < sizes[text[part]][:, None]
                place += starts[text[part]][:, None]
                at = np.where(inside, place - 1, 0)
                if not lead:
                    at[:, 0] = 0
                x = self.vectors.take(rows.take(at), axis=0)
                if not lead:
                    x[:, 0] = self.begin_vector
                gates, _ = _forward(self.model.layer, x, lead)
                own = inside[:, lead:]
                gates = np.ascontiguousarray(_flat(gates))
                yield place[:, lead:][own], gates if own.all() else gates[own.ravel()]

    def score(self, texts: list[str | None]) -> list[tuple]:
        """(n_tokens, n_known, base, gain, hashes and gains of rare words) of each text, in
        natural logs; n_known, base and gain without the words that are not among the
        frequent ones."""
        *whole, ends, hashes, gains = self.score_column(pa.array(texts, pa.string()))
        rare = [(h, g) for h, g in zip(np.split(hashes, ends[:-1]), np.split(gains, ends[:-1]), strict=True)]
        return [(int(n), *x, *r) for n, *x, r in zip(*whole, rare, strict=True)]

    def score_column(self, column: pa.Array) -> tuple[np.ndarray, ...]:
        """What `score` gives, as columns: the rare words of all texts lie one after another,
        and the ends of each text's among them come before their hashes and gains."""
        split = Split(column)
        sizes = split.sizes
        rows = self.find(split.hashes, split.names)
        gain = np.log(self.mixed(rows, sizes).astype(np.float64) + 1e-30)
        n = self.n.take(rows)
        base = np.where(n >= 0, self.counts.log(np.maximum(n, 0)), 0.0)
        starts = np.cumsum(sizes) - sizes
        known = (n > 0).astype(np.int64), base, np.where(n >= 0, gain, 0.0)
        sums = [np.add.reduceat(x, starts) for x in known]
        rare = n < 0
        ends = np.cumsum(np.add.reduceat(rare.astype(np.int64), starts))
        return sizes, *sums, ends, split.hashes.view(np.int64)[rare], gain[rare]


_SCORERS: dict[int, Scorer] = {}
words.register("language model", _SCORERS.clear)


def _scorer(shared) -> Scorer:
    key, data, counts, path = shared.value
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(pickle.loads(data), counts, Subwords(path))
    return _SCORERS[key]


def moved_centres(training: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The means of all training texts nearest to each centre, counted in Spark; a centre
    without texts stays. Sums are whole numbers, so that their order is of no account."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("words")
        total = np.zeros((EXPERTS, BINS), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                split = Split(batch["text"][i : i + 500])
                x = _bins(split.hashes, split.sizes)
                mine = np.argmax(x @ centres.T, axis=1)
                for c in np.unique(mine):
                    total[c] += np.rint(x[mine == c] * 2.0**20).astype(np.int64).sum(0)
        place = np.flatnonzero(total)
        yield pa.record_batch([pa.array(place.astype(np.int32)), pa.array(total.ravel()[place])], ["place", "value"])

    found = training.select("text").mapInArrow(add, "place int, value long")
    table = found.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    mean = np.zeros(EXPERTS * BINS)
    mean[table["place"].to_numpy()] = table["value"].to_numpy()
    mean = mean.reshape(EXPERTS, BINS)
    size = np.linalg.norm(mean, axis=1, keepdims=True)
    return np.where(size > 0, mean / np.maximum(size, 1e-9), centres).astype(np.float32)


def average_layer(dealt: DataFrame, bags: int, model: Model, path: str, steps: int) -> dict[str, np.ndarray]:
    """The mean of the layers that each `bag` of the training texts gives, averaged in
    Spark; of a layer only what has moved from the start passes."""
    start = train(model, [], Subwords(path))
    shared = dealt.sparkSession.sparkContext.broadcast((model, start))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        words.keep_only("tokens")
        pdf = pdf.drop_duplicates(["doc_id", "text"]).sort_values(["doc_id", "text"], na_position="first")
        own, begin = shared.value
        layer = train_column(own, _column(pdf.text), Subwords(path), steps)
        moved = np.concatenate([(layer[n] - begin[n]).ravel() for n in begin])
        place = np.flatnonzero(moved)
        return pd.DataFrame({"place": place.astype(np.int32), "value": moved[place].astype(np.float64)})

    # A bag has about `DOCS_PER_BAG` texts, and a task of its own but for chance.
    fitted = dealt.repartition(bags, "bag").groupBy("bag").applyInPandas(fit, "place int, value double")
    table = fitted.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    used = max(1, dealt.select("bag").distinct().count())
    flat = np.concatenate([v.ravel() for v in start.values()]).astype(np.float64)
    flat[table["place"].to_numpy()] += table["value"].to_numpy() / used
    cuts = np.cumsum([p.size for p in start.values()])[:-1]
    return {n: v.reshape(p.shape).astype(np.float32) for (n, p), v in zip(start.items(), np.split(flat, cuts), strict=True)}


def fit(
    training: DataFrame,
    path: str,
    max_docs: int = MAX_DOCS,
    docs_per_bag: int = DOCS_PER_BAG,
    max_frequent: int = MAX_FREQUENT,
    steps: int = STEPS,
) -> tuple[Model, Counts, DataFrame]:
    """The model that doc_id and text of all rows of `training` give, the counts of frequent
    words, and those of all. The centres start from `max_docs` texts; a bucket of the layer
    has about `docs_per_bag`."""
    bags = max(1, -(-training.count() // docs_per_bag))
    dealt = training.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(bags)).alias("bag"))

    def find_centres(pdf: pd.DataFrame) -> pd.DataFrame:
        words.keep_only("words")
        pdf = pdf.drop_duplicates(["doc_id", "text"]).sort_values(["doc_id", "text"], na_position="first")
        return pd.DataFrame({"centres": [cluster_centres([_split(t) for t in pdf.text[:max_docs]]).tobytes()]})

    # Where the centres start: a bucket has about `docs_per_bag` texts, so one task holds it.
    found = dealt.filter("bag = 0").groupBy("bag").applyInPandas(find_centres, "centres binary").collect()
    centres = np.frombuffer(found[0].centres, np.float32).reshape(EXPERTS, BINS) if found else cluster_centres([])
    centres = moved_centres(training, centres)
    counts = settle(with_ids(count_words(training, centres), path), "word-counts")
    known = frequent_counts(counts, max_frequent)
    tables, prior = expert_tables(id_counts(counts, path, Subwords(path).size))
    model = Model(tables, prior, expert_scale(counts, path, tables, prior).astype(np.float32), {})
    model.layer = average_layer(dealt, bags, model, path, steps)
    return model, known, counts


SCORED = "doc_id long, n_tokens long, n_known long, base double, gain double, rare array<struct<hash: long, gain: double>>"


def scores(
    docs: DataFrame,
    learn: Column,
    tokenizer: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    **options: int,
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of all rows.

    `learn` is a condition on doc_id: the rows that counts and model are learnt from;
    `options` are those of `fit`."""
    spark = docs.sparkSession
    ship(spark)
    path = tokenizer or tokens.default_path()
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    fitted, known, counts = fit(plain.filter(learn), path, **options)
    model = pickle.dumps(fitted)
    shared = spark.sparkContext.broadcast((zlib.crc32(model), model, known, path))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.keep_only("language model", "tokens", "words")
        scorer = _scorer(shared)
        for batch in batches:
            for i in range(0, batch.num_rows, 250):
                part = batch.slice(i, 250)
                *whole, ends, hashes, gains = scorer.score_column(part["text"])
                pairs = pa.StructArray.from_arrays([pa.array(hashes), pa.array(gains)], ["hash", "gain"])
                rare = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pairs)
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                whole = [pa.array(c, k) for c, k in zip(whole, kinds, strict=True)]
                names = ["doc_id", "n_tokens", "n_known", "base", "gain", "rare"]
                yield pa.record_batch([part["doc_id"], *whole, rare], names)

    first = plain.mapInArrow(score, SCORED)
    # Rows are named once, and stay so: the table is written.
    first = settle(first.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    by_hash = counts.groupBy("hash").agg(F.sum("n").alias("n"))
    rare = first.select("row", F.inline("rare")).join(by_hash, "hash", "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    share = F.log((n + F.lit(0.5)) / F.lit(known.total + 0.5 * (known.distinct + 1)))
    gained = F.sum(F.when(F.col("n").isNotNull(), F.col("gain")).otherwise(0.0))
    sums = rare.groupBy("row").agg(
        F.count("n").alias("more_known"), F.sum(share).alias("more_base"), gained.alias("more_gain")
    )
    joined = first.drop("rare").join(sums, "row", "left")
    more = F.coalesce(F.col("more_base"), F.lit(0.0))
    gain = F.col("gain") + F.coalesce(F.col("more_gain"), F.lit(0.0))
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce(F.col("more_known"), F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        ((F.col("base") + more) / LN10).alias("base_score"),
        ((F.col("base") + more + gain) / LN10).alias("score"),
    )
