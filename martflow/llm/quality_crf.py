"""Quality classifier: a linear-chain conditional random field over lines.

Every line that is not blank is labelled good or bad.  Its features are its
own shape (case, punctuation, digits, repeated words, word length ...) and that
of the lines before and after it; a transition score ties neighbouring labels.
A document's share of good text is the mean of its lines' forward-backward
marginals, weighted by their lengths; its score is that share on a logistic
scale fitted with the field.

The field is fitted on the driver on a bounded sample of whole documents,
``TRAIN_DOCUMENTS`` labelled ones (the first in hash order); their texts stay
on the executors, which send ``N_FEATURES`` numbers a line.  While it is fitted a
chain longer than ``CHAIN`` lines counts as several; scores come from whole
chains.  A line starts with its document's label; after a first fit, lines of bad
documents that look good are relabelled, and the field is fitted again.

Null, empty and blank texts have no line and score 0; without usable labels
every line scores 0.5; labels that are null or contradict each other for one
document are not learned; null ids are scored and not held out; repeated rows
give equal rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, read

TRAIN_DOCUMENTS = 3000
CHAIN = 100
THRESHOLD = 0.7
STEPS = 80

# Classes of bytes; letters beyond ASCII count as lower case.
_CLASS = np.full(256, 2, np.int8)
for _b in range(128):
    _c = chr(_b)
    _CLASS[_b] = (1 if _c.isupper() else 2 if _c.islower() else 3 if _c.isdigit() else
                  0 if _c.isspace() or _b < 32 else 4 if _c in ".,;:'\"-?()" else 5)
_CLASS[ord("|")] = 6
N_FEATURES = 13


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines of all texts: own features, length in characters, and the
    index of the text."""
    lines, owner = [], []
    for i, text in enumerate(texts):
        for line in (text or "").split("\n"):
            if line and not line.isspace():
                lines.append(line)
                owner.append(i)
    n = len(lines)
    x = np.zeros((n, N_FEATURES))
    if not n:
        return x, np.empty(0), np.empty(0, np.int64)
    raw = [line.encode("utf-8", "surrogatepass") for line in lines]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in raw])[:-1]])
    kinds = _CLASS[np.frombuffer(b"".join(raw), np.uint8)]
    count = [np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(7)]
    seen = np.maximum(sum(count[1:]), 1)
    letters = np.maximum(count[1] + count[2], 1)
    words = [line.split() for line in lines]
    n_words = np.array([max(len(w), 1) for w in words])
    x[:, 0] = count[1] / letters
    x[:, 1] = count[3] / seen
    x[:, 2] = count[4] / seen
    x[:, 3] = count[5] / seen
    x[:, 4] = count[6] / seen
    x[:, 5] = [sum(map(eq, w, w[1:])) for w in words] / n_words
    x[:, 6] = [len(set(w)) for w in words] / n_words
    x[:, 7] = np.minimum(seen / n_words, 40) / 10
    x[:, 8] = np.log1p(n_words)
    x[:, 9] = [line.rstrip()[-1:] in ".!?" for line in lines]
    x[:, 10] = [line.lstrip()[:1].isupper() for line in lines]
    x[:, 11] = count[5] > n_words / 3
    x[:, 12] = x[:, 6] * x[:, 8]     # a low share of distinct words means more in a long line
    return x, np.array([len(line) for line in lines], float), np.array(owner)


def with_neighbours(x: np.ndarray, owner: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features of a line and of the lines beside it, a constant,
    and whether those lines exist."""
    z = (x - mean) / scale
    same = (owner[1:] == owner[:-1])[:, None]
    before, after = np.zeros_like(z), np.zeros_like(z)
    before[1:], after[:-1] = z[:-1] * same, z[1:] * same
    first, last = np.zeros((len(z), 1)), np.zeros((len(z), 1))
    first[1:], last[:-1] = same, same
    return np.hstack([z, before, after, np.ones((len(z), 1)), first, last])


class Chains:
    """The lines of many documents, to go through position by position."""

    def __init__(self, owner: np.ndarray):
        n = len(owner)
        new = np.concatenate([[True], owner[1:] != owner[:-1]])
        pos = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
        order = np.argsort(pos, kind="stable")
        bounds = np.searchsorted(pos[order], np.arange(1, pos.max() + 2))
        self.later = np.nonzero(~new)[0]
        self.steps = [order[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def marginals(self, unary: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over all chains at once: P(good) of each line, and
        the expected counts of label pairs.  ``unary`` is the score of good
        against bad, ``trans[i, j]`` that of i followed by j."""
        good = 1 / (1 + np.exp(-np.clip(unary, -60, 60)))
        local = np.stack([1 - good, good], axis=1) + 1e-30
        link = np.exp(trans - trans.max())
        fwd, bwd = local.copy(), np.ones((len(unary), 2))
        for at in self.steps:
            step = local[at] * (fwd[at - 1] @ link)
            fwd[at] = step / step.sum(axis=1, keepdims=True)
        for at in reversed(self.steps):
            step = (local[at] * bwd[at]) @ link.T
            bwd[at - 1] = step / step.sum(axis=1, keepdims=True)
        both = fwd * bwd
        pairs = np.zeros((2, 2))
        if len(self.later):
            pair = fwd[self.later - 1][:, :, None] * link * (local * bwd)[self.later][:, None, :]
            pairs = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return both[:, 1] / both.sum(axis=1), pairs


def fit(x: np.ndarray, owner: np.ndarray, y: np.ndarray, steps: int = STEPS,
        ridge: float = 1e-4, rate: float = 0.15) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by Adam on the penalised log likelihood."""
    chains, later = Chains(owner), np.nonzero(owner[1:] == owner[:-1])[0] + 1
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    moment, square = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
    true_pairs = np.zeros((2, 2))
    np.add.at(true_pairs, (y[later - 1], y[later]), 1)
    for step in range(1, steps + 1):
        good, pairs = chains.marginals(x @ w, trans)
        grad = np.concatenate([x.T @ (y - good), (true_pairs - pairs).ravel()]) / len(y)
        grad -= ridge * np.concatenate([w, trans.ravel()])
        moment, square = 0.9 * moment + 0.1 * grad, 0.99 * square + 0.01 * grad ** 2
        move = rate * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        w, trans = w + move[:-4], trans + move[-4:].reshape(2, 2)
    return w, trans


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-4, 1 - 1e-4) / np.clip(1 - p, 1e-4, 1 - 1e-4))


def calibration(share: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic curve from a document's share of good text to P(label 1):
    a few Newton steps, lightly penalised.  It rises, so it keeps the order."""
    x, ab = np.stack([_logit(share), np.ones(len(y))], axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -60, 60)))
        grad = x.T @ (y - p) - 1e-2 * (ab - [1.0, 0.0]) * len(y) ** 0.5
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-2 * len(y) ** 0.5
        ab = ab + np.clip(np.linalg.solve(hess, grad), -1, 1)
    return ab if ab[0] > 0 else np.array([1.0, 0.0])


def shorter(owner: np.ndarray, most: int = CHAIN) -> np.ndarray:
    """Owners of lines with longer chains cut into several."""
    new = np.concatenate([[True], owner[1:] != owner[:-1]])
    pos = np.arange(len(owner)) - np.maximum.accumulate(np.where(new, np.arange(len(owner)), 0))
    return np.cumsum(new | (pos % most == 0))


def learn(x: np.ndarray, length: np.ndarray, owner: np.ndarray, quality: list[int]) -> dict[str, np.ndarray]:
    """The fitted field from the lines of labelled texts."""
    labels, n = np.array(quality, np.int64), len(quality)
    if not len(x) or len(set(quality)) < 2:
        return {"mean": np.zeros(N_FEATURES), "scale": np.ones(N_FEATURES),
                "w": np.zeros(3 * N_FEATURES + 3), "trans": np.zeros((2, 2)), "curve": np.array([1.0, 0.0])}
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z, y, chains = with_neighbours(x, owner, mean, scale), labels[owner], shorter(owner)
    for again in (False, True):
        w, trans = fit(z, chains, y)
        if not again:
            # a good line inside a bad document, as long as the document keeps a bad one
            own = 1 / (1 + np.exp(-np.clip(z[:, :N_FEATURES] @ w[:N_FEATURES] + w[3 * N_FEATURES], -50, 50)))
            good = (y == 0) & (own > 0.9)
            left = np.bincount(owner, (y == 0) & ~good, n)
            y = np.where(good & (left[owner] > 0), 1, y)
    field = {"mean": mean, "scale": scale, "w": w, "trans": trans}
    share, has_lines = share_of_lines(x, length, owner, n, field)
    return field | {"curve": calibration(share[has_lines], labels[has_lines])}


def good_share(texts: list[str | None], field: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Share of each text that lies in good lines, and whether it has lines."""
    return share_of_lines(*line_features(texts), len(texts), field)


def share_of_lines(x: np.ndarray, length: np.ndarray, owner: np.ndarray, n: int,
                   field: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not len(x):
        return np.zeros(n), np.zeros(n, bool)
    z = with_neighbours(x, owner, field["mean"], field["scale"])
    good, _ = Chains(owner).marginals(z @ field["w"], field["trans"])
    total = np.bincount(owner, length, n)
    return np.bincount(owner, good * length, n) / np.maximum(total, 1), total > 0


def document_scores(texts: list[str | None], field: dict[str, np.ndarray]) -> np.ndarray:
    share, has_lines = good_share(texts, field)
    score = 1 / (1 + np.exp(-np.clip(field["curve"][0] * _logit(share) + field["curve"][1], -60, 60)))
    return np.where(has_lines, score, 0.0)


#: Characters scored in one go, and so about what a task holds beside its batch.
PIECE = 1 << 20


def pieces(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``PIECE`` characters."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= PIECE or i - start >= 512:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _scores(texts: list[str | None], field: dict[str, np.ndarray]) -> np.ndarray:
    parts = [document_scores(texts[a:b], field) for a, b in pieces(texts)]
    return np.concatenate(parts) if parts else np.empty(0)


def _scorer(field: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scores(batch.column(1).to_pylist(), field)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])
    return run


def _good_rows(field: dict[str, np.ndarray], text_at: int, threshold: float, step: int = 512):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), step):
                part = batch.slice(start, step)
                yield part.filter(pa.array(_scores(part.column(text_at).to_pylist(), field) >= threshold))
    return run


LINES = "doc_id long, quality int, x binary, length binary"


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of each text's lines, as bytes."""
    for batch in batches:
        xs, lengths = [], []
        for text in batch.column("text").to_pylist():
            x, length, _ = line_features([text])
            xs.append(x.tobytes())
            lengths.append(length.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(xs, pa.binary()),
                                          pa.array(lengths, pa.binary())], names=["doc_id", "quality", "x", "length"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame) -> dict[str, np.ndarray]:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    usable = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_top"))
              .where("quality = _top"))
    sample = (usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCUMENTS)
              .select(F.col("doc_id").alias("_id"), "quality"))
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
            .select(F.col("_id").alias("doc_id"), F.col("quality").cast("int").alias("quality"), "text")
            .mapInArrow(lean(_lines), LINES).collect())
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    x = np.frombuffer(b"".join(r["x"] for r in rows)).reshape(-1, N_FEATURES)
    counts = [len(r["length"]) // 8 for r in rows]
    return learn(x, np.frombuffer(b"".join(r["length"] for r in rows)), np.repeat(np.arange(len(rows)), counts),
                 [r["quality"] for r in rows])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    field = fitted(docs, labels)
    return (docs.select("doc_id", "text").mapInArrow(lean(_scorer(field)), "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at least
    ``threshold``.  Rows are scored where they are; nothing is shuffled."""
    run = _good_rows(fitted(docs, labels), docs.columns.index("text"), threshold)
    return docs.mapInArrow(lean(run), docs.schema)


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
