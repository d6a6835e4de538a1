"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; a sample of all documents, whatever they are,
is unlabelled. The risk of calling text clean is taken from the unlabelled part less the
share of it that must be toxic (the class prior times the risk over positives), and never
below zero. Documents labelled clean only serve to estimate the class prior.

The model is a noisy or over the distinct words of a text: a word sets it off with a
chance that is logistic in the weights of the word and of its character n-grams, hashed
into a table. A long clean text so gathers next to nothing, and a few words suffice.

Several classifiers are trained in numpy, each in a task of its own on the positives and
its share of the unlabelled sample, and their word scores averaged. The sample is bounded: `max_positive` and
`max_unlabelled` documents, chosen by a hash of their id. Scoring covers every text.

Defined cases: null and empty texts have no words and get the score 0; null labels count
as no label; repeated rows count as often as they occur; without any confirmed toxic
document all scores are 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import string
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfdiff.llm.spark_tools import few
from shelfdiff.llm.words import keep_only, register
from shelfdiff.session import settle, ship

BITS = 18
NGRAMS = (4, 5)
LONGEST = 40  # characters of a word that make n-grams; the word itself counts whole
MAX_POSITIVE = 1_500
MAX_UNLABELLED = 12_000
CLASSIFIERS = 3
STEPS = 120
RATE = 0.15
DECAY = 2e-5
START = -7.0
CACHE_WORDS = 300_000

_MASK = (1 << BITS) - 1


def words_of(text: str | None) -> set[str]:
    """Distinct words in lower case without punctuation at their ends."""
    if not text:
        return set()
    found = {w.strip(string.punctuation) for w in set(text.lower().split())}
    found.discard("")
    return found


def features(word: str) -> list[int]:
    """Places of a word and its n-grams (of bytes) in the weight table."""
    edged = f"<{word[:LONGEST]}>".encode()
    grams = {edged[i : i + n] for n in NGRAMS for i in range(len(edged) - n + 1)}
    grams.add(b"=" + word.encode())
    return [crc & _MASK for crc in map(zlib.crc32, grams)]


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def _numbered(texts: Iterable[list[str]], vocabulary: dict[str, int]) -> list[np.ndarray]:
    """The words of each text as numbers; new ones are added."""
    out = []
    for words in texts:
        for w in words:
            vocabulary.setdefault(w, len(vocabulary))
        out.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
    return out


def train(
    positive: Iterable[list[str]], unlabelled: Iterable[list[str]], prior: float, steps: int = STEPS
) -> np.ndarray:
    """Weights by the non-negative risk estimator, with Adam; the bias comes last."""
    vocabulary: dict[str, int] = {}
    hits = _numbered(positive, vocabulary)
    texts = [*hits, *_numbered(unlabelled, vocabulary)]
    of_text = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    word_of = np.concatenate(texts)
    places, ends = array("i"), array("i")
    for word in vocabulary:
        places.extend(features(word))
        ends.append(len(places))
    feature_of = np.frombuffer(places, np.int32)
    n_words, n_texts = len(vocabulary), len(texts)
    of_word = np.repeat(np.arange(n_words, dtype=np.int32), np.diff(ends, prepend=0))
    n_p, n_u = len(hits), n_texts - len(hits)
    del vocabulary, texts, hits
    weights = np.zeros((1 << BITS) + 1)
    weights[-1] = START
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        score = np.bincount(of_word, weights[feature_of], n_words) + weights[-1]
        load = np.bincount(of_text, _softplus(score)[word_of], n_texts) + 1e-9
        # -log(1 - p) is the load itself, -log p that of its complement.
        p, u = load[:n_p], load[n_p:]
        slope_hit = -1 / np.expm1(np.minimum(p, 50))
        clean_risk = u.mean() - prior * p.mean()
        if clean_risk >= 0:
            slope_p = prior * (slope_hit - 1) / n_p
            slope_u = np.full(n_u, 1 / n_u)
        else:
            # The estimate went below zero: climb back, the positives' own risk aside.
            slope_p = np.full(n_p, prior / n_p)
            slope_u = np.full(n_u, -1 / n_u)
        by_text = np.concatenate([slope_p, slope_u])
        by_word = np.bincount(word_of, by_text[of_text], n_words) / (1 + np.exp(-score))
        slope = np.bincount(feature_of, by_word[of_word], 1 << BITS)
        slope = np.append(slope, by_word.sum()) + DECAY * np.append(weights[:-1], 0)
        first += 0.1 * (slope - first)
        second += 0.01 * (slope**2 - second)
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights -= RATE * move
    return weights.astype(np.float32)


def _folded(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def _lowest(ids: DataFrame, n: int) -> DataFrame:
    """At most `n` distinct ids, those with the lowest hashes."""
    some = ids.filter("doc_id is not null").distinct()
    return some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    classifiers: int = CLASSIFIERS,
) -> np.ndarray:
    """Weights of the averaged classifiers; the bias is last.

    `learn`, a condition on `doc_id`, limits the rows that labels and text are learnt
    from. The sample is dealt to as many tasks as there are classifiers."""
    spark = docs.sparkSession
    ship(spark)
    learn = F.lit(True) if learn is None else learn
    texts = _folded(docs, doc_id, text).filter(learn)
    marks = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).alias("mark"))
    marks = marks.filter(learn & F.col("mark").isNotNull())
    prior = marks.agg(F.avg((F.col("mark") == 1).cast("double"))).first()[0] or 0.0
    toxic = _lowest(marks.filter("mark = 1").select("doc_id"), max_positive)
    if not prior:
        return np.append(np.zeros(1 << BITS, np.float32), np.float32(-np.inf))
    anyhow = _lowest(texts.select("doc_id"), max_unlabelled)
    chosen = toxic.withColumn("kind", F.lit(1)).unionByName(anyhow.withColumn("kind", F.lit(0)))
    chosen = settle(chosen, "toxicity-ids")
    sample = texts.join(few(chosen), "doc_id")
    every = F.sequence(F.lit(0), F.lit(classifiers - 1))
    own = F.array(F.pmod(F.xxhash64("doc_id"), F.lit(classifiers)).cast("int"))
    bag = F.explode(F.when(F.col("kind") == 1, every).otherwise(own))

    def learn_bag(pdf: pd.DataFrame) -> pd.DataFrame:
        keep_only()
        pdf = pdf.sort_values(["doc_id", "kind"])
        if pdf.kind.nunique() < 2:
            return pd.DataFrame({"weights": []})
        sides = [(sorted(words_of(t)) for t in pdf.text[pdf.kind == k]) for k in (1, 0)]
        return pd.DataFrame({"weights": [train(*sides, prior).tobytes()]})

    trained = sample.select("doc_id", "kind", "text", bag.alias("bag"))
    rows = trained.groupBy("bag").applyInPandas(learn_bag, "weights binary").collect()
    if not rows:
        return np.append(np.zeros(1 << BITS, np.float32), np.float32(-np.inf))
    return np.mean([np.frombuffer(r.weights, np.float32) for r in rows], axis=0)


class WordLoads(dict):
    """What each word adds to a text's load, worked out once per worker."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights[:-1].tolist()
        self.bias = float(weights[-1])

    def __missing__(self, word: str) -> float:
        score = self.bias + sum(map(self.weights.__getitem__, features(word)))
        value = math.log1p(math.exp(score)) if score < 30 else score
        if len(word) <= LONGEST:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value

    def score(self, text: str | None) -> float:
        return -math.expm1(-math.fsum(map(self.__getitem__, words_of(text))))


_LOADS: dict[int, WordLoads] = {}
register("toxicity", _LOADS.clear)


def _loads(shared) -> WordLoads:
    if shared.value[0] not in _LOADS:
        _LOADS.clear()
        _LOADS[shared.value[0]] = WordLoads(shared.value[1])
    return _LOADS[shared.value[0]]


def _share(spark: SparkSession, weights: np.ndarray):
    """Some megabytes, however large the tables are; named by their own checksum."""
    return spark.sparkContext.broadcast((zlib.crc32(weights.tobytes()), weights))


def scored(docs: DataFrame, weights: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score, 0 to 1, of every row."""
    ship(docs.sparkSession)
    shared = _share(docs.sparkSession, weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("toxicity")
        loads = _loads(shared)
        for batch in batches:
            found = [loads.score(t.as_py()) for t in batch["text"]]
            yield pa.record_batch([batch["doc_id"], pa.array(found, pa.float64())], ["doc_id", "score"])

    return _folded(docs, doc_id, text).mapInArrow(score, "doc_id long, score double")


def remove_toxic(
    docs: DataFrame, weights: np.ndarray, text: str = "text", limit: float = 0.5
) -> DataFrame:
    """`docs` without the rows that score `limit` or more; all columns stay."""
    ship(docs.sparkSession)
    shared = _share(docs.sparkSession, weights)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("toxicity")
        loads = _loads(shared)
        for batch in batches:
            keep = [loads.score(t.as_py()) < limit for t in batch[text]]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
