"""Quality scores from two compression dictionaries, one of good and one of bad text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitscope.llm.common import held_out, keyed_texts, labelled_sample, text_batches

SAMPLE_PER_CLASS = 3000
SAMPLE_MAX_CHARS = 20_000
DICTIONARY_BYTES = 262_144
LEVEL = 3
BLOCK_BYTES = 16_384


def dictionary(samples: list[bytes], size: int) -> bytes:
    """Frequent stretches of the samples; their plain text where there are too few to train on."""
    plain = b"\n".join(samples)[-size:]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if samples else plain
    except zstandard.ZstdError:
        return plain


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not content:
        return zstandard.ZstdCompressor(level=LEVEL, **options)
    known = zstandard.ZstdCompressionDict(content)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=known, **options)


def blocks(data: bytes) -> list[bytes]:
    """The text in as many pieces of about equal length as keep each within the block size."""
    n = max(1, -(-len(data) // BLOCK_BYTES))
    cuts = [len(data) * i // n for i in range(n + 1)]
    return [data[start:end] for start, end in zip(cuts, cuts[1:])]


def features(good, bad, data: bytes) -> list[float]:
    """The normalised difference of the two sizes, and the smaller's share of the plain size.

    Each block is compressed afresh, so a long text's own beginning never stands in for the
    dictionaries; the sizes are sums over all blocks.
    The share tells text that any dictionary shrinks, such as one word over and over; it enters in
    steps, and the difference also by itself times the share.
    """
    pieces = blocks(data)
    with_good, with_bad = (sum(len(c.compress(piece)) for piece in pieces) for c in (good, bad))
    difference = (with_bad - with_good) / (with_bad + with_good)
    share = min(with_good / (len(data) + 1), 1.2)
    steps = [min(share, top) for top in (0.1, 0.2, 0.4)]
    return [difference, share, *steps, difference * steps[-1]]


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> np.ndarray:
    """Weights and intercept by Newton's method, each step halved until the loss falls."""
    x = np.c_[x, np.ones(len(x))]
    ridge = np.r_[np.full(x.shape[1] - 1, penalty), 1e-6]

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - (y * z).sum() + (ridge * w * w).sum() / 2

    w, now = np.zeros(x.shape[1]), len(x) * np.log(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        while np.abs(step).max() > 1e-9 and loss(w - step) > now:
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        w = w - step
        now = loss(w)
    return w


def fit(sample: list[tuple[int, str]], good_share: float) -> dict:
    """Both dictionaries from one half of the sample, the calibration from the other half.

    ``good_share`` is the share of good rows among all labelled training rows; the sample, drawn
    per class, is weighted back to it. With a class missing, every score is that share.
    """
    by_class = [[text.encode() for y, text in sample if y == label] for label in (0, 1)]
    model = {"share": good_share, "good": b"", "bad": b"", "weights": None}
    if min(map(len, by_class)) < 2:
        return model
    model["bad"], model["good"] = (dictionary(texts[::2], DICTIONARY_BYTES) for texts in by_class)
    good, bad = compressor(model["good"]), compressor(model["bad"])
    rest = [(label, text) for label in (0, 1) for text in by_class[label][1::2]]
    x = np.array([features(good, bad, text) for _, text in rest])
    y = np.array([label for label, _ in rest], dtype=float)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = logistic((x - mean) / spread, y)
    drawn = y.mean()
    weights[-1] += np.log(good_share / (1 - good_share)) - np.log(drawn / (1 - drawn))
    return model | {"weights": weights, "mean": mean, "spread": spread}


class Scores:
    """A model ready to score texts."""

    def __init__(self, model: dict):
        self.model = model
        self.good, self.bad = compressor(model["good"]), compressor(model["bad"])

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        model = self.model
        if model["weights"] is None:
            return np.full(len(texts), model["share"])
        x = np.array([features(self.good, self.bad, (t or "").encode()) for t in texts])
        z = (x.reshape(len(texts), -1) - model["mean"]) / model["spread"] @ model["weights"][:-1]
        return 1 / (1 + np.exp(-np.clip(z + model["weights"][-1], -40, 40)))


def scorer(model: dict):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(model)
        for ids, texts in text_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(scores(texts), pa.float64())],
                names=["doc_id", "score"],
            )

    return score


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> dict:
    """A model from at most ``per_class`` labelled texts per class, of 20,000 characters at most.

    Held-out rows are never learnt from. The class shares come from all training labels.
    """
    sample = labelled_sample(docs, labels, "quality", per_class, SAMPLE_MAX_CHARS)
    counted = labels.filter(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    n, good = counted.agg(F.count(F.lit(1)), F.sum("quality")).first()
    return fit(sample, (good + 1) / (n + 2) if n else 0.5)


def quality_scores(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score in 0 to 1 and predicted (1 from ``threshold`` up), for every row.

    A text is compressed with either dictionary, in blocks of 16 KB; the normalised difference of the sizes is
    calibrated into a score. Null and empty texts get the score of the empty text, repeated rows
    equal scores. Other columns are ignored. An empty table gives no rows; without labels of both
    classes all scores are the share of good ones, or a half.
    """
    scored = keyed_texts(docs).mapInArrow(scorer(model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores ``threshold`` or more.

    A null text scores as the empty one does, repeated rows fare alike, a very long text is judged by
    all its blocks, and an empty table stays empty.
    """
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(model)
        for batch in batches:
            found = scores(batch.column(at).to_pylist())
            yield batch.filter(pa.array(found >= threshold, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
