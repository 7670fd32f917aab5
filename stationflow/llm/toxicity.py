"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

Each sentence gets a logistic score, a document the noisy-or of its sentences. Only documents carry labels; the
sentence scores are what makes the noisy-or agree with them, and so point at the offending sentences.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import per_text, quoted, raw_texts
from stationflow.storage import stage

SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
WORD = re.compile(r"[^\W\d_]+")
SHOUT = re.compile(r"[.!?]*!!")
WORD_ENTRIES = 300_000
STEMS = range(3, 9)


@dataclass(frozen=True)
class Training:
    """At most about ``documents`` labelled documents train the scores, chosen by a hash of their id; at most
    ``features`` words, stems and marks carry weight, each seen ``least`` times in toxic documents and ``lift`` times
    as often as in others. A toxic document, the rare class, counts ``toxic_weight`` times."""

    documents: int = 8_000
    features: int = 4_096
    least: int = 4
    lift: float = 2.0
    toxic_weight: float = 12.0
    rounds: int = 400
    rate: float = 0.15
    penalty: float = 2e-5


def word_features(word: str) -> list[str]:
    """A word and its stems of 3 to 8 letters, each marked as such."""
    return [word, *(word[:n] + "-" for n in STEMS if n < len(word))]


def sentence_marks(sentence: str) -> list[str]:
    return ["!!"] if SHOUT.search(sentence) else []


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def scorer(self):
        """A function from a text to (document score, [(start, end, sentence score)] of marked sentences)."""
        known: dict[str, tuple[str, float] | tuple[()]] = {}
        weights, bias = self.weights, self.bias
        blank = 1.0 / (1.0 + np.exp(-bias))

        def learn(word: str) -> tuple[str, float] | tuple[()]:
            """The word in lower case and its weight, or nothing if it has none."""
            if len(known) >= WORD_ENTRIES:
                known.clear()
            lower = word.lower()
            own = [weights[f] for f in word_features(lower) if f in weights]
            found = known[word] = (lower, sum(own)) if own else ()
            return found

        def score(text: str) -> tuple[float, list[tuple[int, int, float]]]:
            marked, clean, spare = [], 0.0, 0
            for hit in SENTENCE.finditer(text):
                sentence = hit.group()
                found: dict[str, float] = {}
                for word in WORD.findall(sentence):
                    weighed = known.get(word)
                    if weighed is None:
                        weighed = learn(word)
                    if weighed:
                        found[weighed[0]] = weighed[1]
                if "!!" in sentence and "!!" in weights:
                    found.update((mark, weights[mark]) for mark in sentence_marks(sentence))
                if found:
                    p = 1.0 / (1.0 + np.exp(-np.clip(bias + sum(found.values()), -30, 30)))
                    clean += np.log1p(-min(p, 1 - 1e-12))
                    marked.append((*hit.span(), float(p)))
                else:
                    spare += 1
            clean += max(spare, 0 if marked else 1) * np.log1p(-blank)
            return float(-np.expm1(clean)), marked

        return score


def _bags(weights: set[str]):
    """Function from a text to its distinct sentences with their number: the features of each different word."""
    known: dict[str, tuple[str, ...]] = {}

    def bag(data: bytes | None) -> list[dict]:
        sets: Counter = Counter()
        for sentence in SENTENCE.findall((data or b"").decode("utf-8", "replace")):
            found: list[str] = []
            for word in {w.lower() for w in WORD.findall(sentence)}:
                if word not in known:
                    if len(known) >= WORD_ENTRIES:
                        known.clear()
                    known[word] = tuple(f for f in word_features(word) if f in weights)
                found += known[word]
            if "!!" in weights:
                found += sentence_marks(sentence)
            sets[tuple(sorted(found))] += 1
        return [{"features": list(k), "n": n} for k, n in (sets or Counter({(): 1})).items()]

    return bag


def _feature_counts(only: set[str] | None):
    """How often the task's documents have each feature: a stem once for each different word of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for data in raw_texts(batch.column(0)):
                text = (data or b"").decode("utf-8", "replace")
                found = [f for w in {w.lower() for w in WORD.findall(text)} for f in word_features(w)]
                found += sentence_marks(text)
                seen.update(found if only is None else filter(only.__contains__, found))
                if len(seen) > 1_000_000:
                    yield pa.record_batch([pa.array(list(seen)), pa.array(list(seen.values()))], ["feature", "n"])
                    seen.clear()
        yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["feature", "n"])

    return run


def _count(texts: DataFrame, only: set[str] | None) -> DataFrame:
    return texts.select("text").mapInArrow(_feature_counts(only), "feature string, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))


def one_of_each_chain(ranked: list[str]) -> list[str]:
    """Of a word and its stems the first in rank: words that share a stem share its weight, unless one says more by
    itself."""
    kept: dict[str, None] = {}
    taken: set[str] = set()  # what is kept, with all its stems
    for feature in ranked:
        stem = feature.rstrip("-")
        shorter = {stem[:n] + "-" for n in STEMS if n < len(stem)}
        if feature not in taken and shorter.isdisjoint(kept):
            kept[feature] = None
            taken |= shorter | {feature}
    return list(kept)


def fit(
    bags: list[list[tuple[list[int], int]]], toxic: np.ndarray, first: np.ndarray, training: Training
) -> tuple[np.ndarray, float]:
    """Weights of features and bias that make the noisy-or of sentence scores likeliest, by full-batch Adam from the
    weights ``first``."""
    sentence_doc, times, pair_sentence, pair_feature = [], [], [], []
    for doc, bag in enumerate(bags):
        for found, n in bag:
            pair_sentence += [len(times)] * len(found)
            pair_feature += found
            sentence_doc.append(doc)
            times.append(n)
    sentence_doc, times = np.array(sentence_doc), np.array(times, float)
    pair_sentence, pair_feature = np.array(pair_sentence, np.int64), np.array(pair_feature, np.int64)
    features = len(first)
    w = np.append(first, -5.0)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, training.rounds + 1):
        z = w[-1] + np.bincount(pair_sentence, w[pair_feature], len(times))
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(np.bincount(sentence_doc, times * np.log1p(-np.minimum(p, 1 - 1e-12)), len(bags)))
        pull = np.where(toxic == 1, training.toxic_weight * clean / np.maximum(1 - clean, 1e-9), -1.0)
        slope = pull[sentence_doc] * times * p
        gradient = np.append(np.bincount(pair_feature, slope[pair_sentence], features), slope.sum()) / len(bags)
        gradient[:-1] -= training.penalty * w[:-1] / 10
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        w += training.rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w[:-1], float(w[-1])


def train(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    usable: Column | None = None,
    training: Training | None = None,
) -> Model:
    """Learn from the documents of ``df`` with a label in ``labels`` (doc_id, ``label``) and a true ``usable``.

    The sample is bounded in rows, so its ids go to all tasks and only its texts are shuffled. Features are counted
    in tasks before the shuffle, in toxic documents first and then, for those that occur often enough, in the rest.
    Ids or labels that are null are left out, of repeated labels of an id the largest counts, of repeated documents
    the one whose text has the smallest hash. If a class is missing, every text gets the share of toxic labels as
    its score.
    """
    training = training or Training()
    rows = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_toxic"))
    rows = rows.where("_id is not null and _toxic is not null").groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    if usable is not None:
        rows = rows.where(usable)
    total = rows.count()
    share = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1_000_000))
    rows = rows.where(share < int(1_000_000 * min(1.0, training.documents / max(1, total))))
    texts = df.select(quoted(doc_id).alias("_id"), quoted(text).cast("string").alias("text"))
    found = texts.join(F.broadcast(rows), "_id").withColumn("_pick", F.struct(F.xxhash64("text"), "text"))
    sample = found.groupBy("_id", "_toxic").agg(F.min("_pick")["text"].alias("text"))
    sample = stage(sample, "toxic-sample")
    sizes = {r["_toxic"]: r["count"] for r in sample.groupBy("_toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        odds = (bad + 0.01) / (good + 0.01)
        return Model({}, float(np.log(odds)))
    toxic = _count(sample.where("_toxic = 1"), None).where(F.col("n") >= training.least)
    toxic = toxic.orderBy(F.desc("n"), "feature").limit(16 * training.features)
    often = {r["feature"]: r["n"] for r in toxic.collect()}
    others = {r["feature"]: r["n"] for r in _count(sample.where("_toxic = 0"), set(often)).collect()}

    def strength(f: str) -> float:
        a, b = (often[f] + 0.5) / (bad + 1), (others.get(f, 0) + 0.5) / (good + 1)
        return often[f] * np.log(a / b) if a >= training.lift * b else 0.0

    odds = {f: (often[f] + 0.5) / (others.get(f, 0) + 0.5) for f in often if strength(f) > 0}
    chosen = one_of_each_chain(sorted(odds, key=lambda f: (-strength(f), len(f), f)))[: training.features]
    at = {f: i for i, f in enumerate(chosen)}
    kind = "array<struct<features: array<string>, n: int>>"
    vocabulary = set(chosen)
    found = sample.select("_toxic", per_text(lambda: _bags(vocabulary), kind)(F.col("text")).alias("bag")).collect()
    bags = [[([at[f] for f in s["features"]], s["n"]) for s in r["bag"]] for r in found]
    # Words that never stand alone in training say little of their own weight: it begins at their log odds.
    first = np.array([np.log(odds[f] * (good + 1) / (bad + 1)) for f in chosen], float)
    weights, bias = fit(bags, np.array([r["_toxic"] for r in found]), first, training)
    return Model({f: float(w) for f, w in zip(chosen, weights) if abs(w) > 1e-6}, bias)


VERDICT = "score double, predicted int, sentences array<struct<start: int, stop: int, score: double>>"


def score_toxicity(
    df: DataFrame, model: Model, text: str = "text", into: str = "toxicity", threshold: float = 0.7, offence: float = 0.5
) -> DataFrame:
    """``df`` with a struct ``into``: score, predicted (score >= ``threshold``), and the spans (code points) and
    scores of sentences of at least ``offence``.

    One map over whole texts, no shuffle; the model is a bounded table. A null or empty text counts as one
    sentence without marks. Rows are judged one by one; an existing column ``into`` is replaced.
    """
    def start():
        score = model.scorer()

        def judge(data: bytes | None) -> dict:
            value, marked = score((data or b"").decode("utf-8", "replace"))
            spans = [{"start": a, "stop": b, "score": p} for a, b, p in marked if p >= offence]
            return {"score": value, "predicted": int(value >= threshold), "sentences": spans}

        return judge

    return df.withColumn(into, per_text(start, VERDICT)(quoted(text)))
