"""Toxicity by multiple-instance learning: sentences are scored, documents carry the labels."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitscope.llm.common import held_out, keyed_texts, labelled_sample, text_batches

SAMPLE_PER_CLASS = 3000
SAMPLE_MAX_CHARS = 20_000
LEAST_DOCUMENTS = 4
CLEAR = 3.0
ROUNDS = 300
STEMS = (4, 5, 6)
MEMO_WORDS = 500_000
BAG_WORDS = 40
PART_WORDS = 3_000  # about what a training text has at most

SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ENDS = b".!?\n"


def word_table() -> bytes:
    """Maps bytes: A-Z to lower case, ends of sentences to a line feed, other non-letters to blanks."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for letter in range(ord("a"), ord("z") + 1):
        table[letter] = table[letter - 32] = letter
    for end in ENDS:
        table[end] = ord("\n")
    return bytes(table)


TABLE = word_table()


def bags(words: list[bytes]) -> list[list[bytes]]:
    """A sentence in as many bags of about equal length as keep each within BAG_WORDS."""
    if len(words) <= BAG_WORDS:
        return [words] if words else []
    n = -(-len(words) // BAG_WORDS)
    cuts = [len(words) * i // n for i in range(n + 1)]
    return [words[a:b] for a, b in zip(cuts, cuts[1:])]


def sentences(text: str) -> list[list[bytes]]:
    """The words of each sentence that has some; long ones, or text without stops, in several bags."""
    split = (part.split() for part in text.encode().translate(TABLE).split(b"\n"))
    return [bag for words in split for bag in bags(words)]


def word_features(word: bytes) -> list[bytes]:
    """The word, and its beginnings, which words of one stem share."""
    return [word + b"$"] + [word[:n] for n in STEMS if len(word) >= n]


def fit(sample: list[tuple[int, str]], toxic_share: float) -> dict:
    """Weights of words and stems, so that a noisy-or over the sentences explains the labels.

    A sentence with logit z is toxic with p = sigmoid(z), a document with 1 - prod(1 - p). z is a
    bias plus the weights of the sentence's distinct words. Weighted are words and stems that occur
    clearly more often (by three standard errors of the log odds) in toxic documents; weights
    stay positive, as one toxic sentence is enough. The penalised likelihood is climbed by
    full-batch steps of Adam, with rows weighted back to the share of toxic ones among all labels.
    """
    model = {"share": toxic_share, "weights": None, "bias": 0.0}
    labels = np.array([y for y, _ in sample], dtype=float)
    if not 0 < labels.sum() < len(labels):
        return model
    split = [[set(words) for words in sentences(text)] for _, text in sample]
    seen: list[Counter] = [Counter(), Counter()]
    for y, parts in zip(labels, split):
        seen[int(y)].update({f for words in parts for w in words for f in word_features(w)})
    n1, n0 = labels.sum(), (1 - labels).sum()

    def clearness(f: bytes) -> float:
        a, b = seen[1][f], seen[0][f]
        if a + b < min(LEAST_DOCUMENTS, n1):
            return 0.0
        odds = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
        return odds / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))

    known = sorted(f for f in seen[1] if clearness(f) >= CLEAR)
    place = {f: i for i, f in enumerate(known)}
    of_sentence, of_feature, of_document = [], [], []
    for i, parts in enumerate(split):
        for words in parts:
            hits = [place[f] for w in words for f in word_features(w) if f in place]
            of_sentence += [len(of_document)] * len(hits)
            of_feature += hits
            of_document.append(i)
    of_sentence, of_feature, of_document = (
        np.array(a, dtype=np.int64) for a in (of_sentence, of_feature, of_document)
    )
    n, size = len(of_document), len(place)
    theta = np.r_[np.full(size, 1.0), -6.0]
    weight = np.where(labels == 1, toxic_share / n1, (1 - toxic_share) / n0) * len(labels)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, ROUNDS + 1):
        z = np.bincount(of_sentence, theta[of_feature], minlength=n) + theta[-1]
        z = np.clip(z, -30, 30)
        p = 1 / (1 + np.exp(-z))
        clean = np.exp(-np.bincount(of_document, np.logaddexp(0, z), minlength=len(labels)))
        clean = np.clip(clean, 1e-12, 1 - 1e-12)
        pull = np.where(labels == 1, -clean / (1 - clean), 1.0) * weight
        slope = p * pull[of_document]
        gradient = np.r_[np.bincount(of_feature, slope[of_sentence], minlength=size), slope.sum()]
        gradient[:-1] += 0.02 * theta[:-1] + 0.03
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = 0.2 * (1 - step / (ROUNDS + 1)) + 0.005
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        theta[:-1] = np.maximum(theta[:-1], 0)
    kept = {f: float(theta[i]) for f, i in place.items() if theta[i] > 0.05}
    return model | {"weights": kept, "bias": float(theta[-1])}


class WordWeights(dict):
    """The weight of each word met so far, worked out once; forgets all when it has grown large."""

    def __init__(self, weights: dict[bytes, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = sum(self.weights.get(f, 0.0) for f in word_features(word))
        self[word] = value
        return value


def document_score(text: str, known: WordWeights, bias: float) -> tuple[float, list[dict]]:
    """The noisy-or over the sentences, and the places of those that are likelier toxic than not.

    A sentence counts by its excess over one without known words, so those add nothing, however
    many. A text longer than those that the model was fitted to counts by its worst part of their
    length, as small doubts would add up over any number of sentences. Places are positions of
    characters.
    """
    worst, suspect, plain = 0.0, False, float(np.logaddexp(0, bias))
    total, n_words = 0.0, 0
    for words in sentences(text):
        if n_words > PART_WORDS:
            total, n_words = 0.0, 0
        n_words += len(words)
        if any(map(known.__getitem__, words)):
            z = bias + sum(map(known.__getitem__, set(words)))
            total += float(np.logaddexp(0, z)) - plain
            worst = max(worst, total)
            suspect = suspect or z >= 0
    return 1.0 - float(np.exp(-worst)), offending(text, known, bias) if suspect else []


def offending(text: str, known: WordWeights, bias: float) -> list[dict]:
    """The sentences, or the bags of long ones, that are likelier toxic than not."""
    found = []
    for match in SENTENCE.finditer(text):
        words = [(m.group().encode().translate(TABLE).split(), m) for m in WORD.finditer(match.group())]
        flat = [(w, m) for own, m in words for w in own]
        start = 0
        whole = bags([w for w, _ in flat])
        for bag in whole:
            z = bias + sum(map(known.__getitem__, set(bag)))
            if z >= 0:
                first = 0 if len(whole) == 1 else flat[start][1].start()
                last = len(match.group()) if len(whole) == 1 else flat[start + len(bag) - 1][1].end()
                place = {"start": match.start() + first, "end": match.start() + last}
                found.append(place | {"score": 1 / (1 + np.exp(-z))})
            start += len(bag)
    return found


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def scorer(model: dict):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordWeights(model["weights"] or {})
        for ids, texts in text_batches(batches):
            if model["weights"] is None:
                found = [(model["share"], [])] * len(ids)
            else:
                found = [document_score(text, known, model["bias"]) for text in texts]
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([s for s, _ in found], pa.float64()),
                pa.array([spans for _, spans in found], SPANS),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "sentences"])

    return score


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> dict:
    """A model from at most ``per_class`` labelled texts per class, of 20,000 characters at most.

    Held-out rows are never learnt from. The class shares come from all training labels.
    """
    sample = labelled_sample(docs, labels, "toxic", per_class, SAMPLE_MAX_CHARS)
    counted = labels.filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    n, toxic = counted.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    return fit(sample, (toxic + 1) / (n + 2) if n else 0.5)


def toxicity_scores(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending sentences, for every row.

    A sentence ends at ``.``, ``!``, ``?`` or a line feed, and is cut into bags of 40 words at most;
    words are runs of letters, with A-Z in lower case. A very long text scores as its worst 3,000
    words do. ``sentences`` lists those with a probability of a half or more, as start, end (in
    characters) and score. Null and empty texts have no sentence and score 0, repeated rows score
    equally. Other columns are ignored. An empty table gives no rows; without labels of both
    classes all scores are the share of toxic ones, or a half.
    """
    spans = "array<struct<start: long, end: long, score: double>>"
    scored = keyed_texts(docs).mapInArrow(
        scorer(model), f"doc_id long, score double, sentences {spans}"
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "sentences",
    )
