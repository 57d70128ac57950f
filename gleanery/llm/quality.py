"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines
before and after it, together with the transitions between labels. A document's
score is the mean of its lines' marginal probabilities of being good, from the
forward-backward algorithm, weighted by the lines' lengths.

The model is trained on a bounded sample of labelled documents, whose lines all
take the label of the document; scoring reads every whole text once and
shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import prepare

from .words import SPACE, small, text_slices, word_bounds, word_hashes

FOLDS = 5
# Bounds of the training sample: documents, and lines of a document (longer ones are not taken).
TRAIN_DOCS = 3000
TRAIN_LINES = 300
ITERATIONS = 120

_CODE = np.arange(256)
_UPPER = (_CODE >= 65) & (_CODE <= 90)
_LETTER = _UPPER | ((_CODE >= 97) & (_CODE <= 122)) | (_CODE >= 128)
_DIGIT = (_CODE >= 48) & (_CODE <= 57)
_STOP = np.isin(_CODE, list(b".,;:'-"))
_LOUD = np.isin(_CODE, list(b"!?"))
_BAR = np.isin(_CODE, list(b"|<>{}[]\\/_="))
_ODD = np.isin(_CODE, list(b"#$%&*+@^~`\"()"))
_MARKS = np.stack([_UPPER, _LETTER, _DIGIT, SPACE, _STOP, _LOUD, _BAR, _ODD])
FEATURES = 18


def line_features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, first line of each text and one more) of the lines of a slice of texts."""
    cut = np.union1d(offsets[:-1], np.flatnonzero(data == 10) + 1)
    ends_text = np.isin(offsets[:-1], cut)
    assert ends_text.all()
    # A text has as many lines as line feeds plus one; a text that is empty has one empty line.
    feeds = np.flatnonzero(data == 10)
    per_text = np.searchsorted(feeds, offsets[1:]) - np.searchsorted(feeds, offsets[:-1]) + 1
    first = np.concatenate([[0], np.cumsum(per_text)])
    begin = np.zeros(first[-1], dtype=np.int64)
    begin[first[:-1]] = offsets[:-1]
    inner = np.ones(first[-1], dtype=bool)
    inner[first[:-1]] = False
    begin[inner] = feeds + 1
    end = np.zeros_like(begin)
    end[first[1:] - 1] = offsets[1:]
    last = np.ones(first[-1], dtype=bool)
    last[first[1:] - 1] = False
    end[last] = feeds
    length = end - begin

    def total(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return (sums[b] - sums[a]).astype(np.float64)

    size = np.maximum(length, 1)
    marks = [total(mark[data], begin, end) for mark in _MARKS]
    starts, ends, _ = word_bounds(offsets, data)
    hashes = word_hashes(data, starts, ends)
    a, b = np.searchsorted(starts, begin), np.searchsorted(starts, end)
    words = (b - a).astype(np.float64)
    many = np.maximum(words, 1)
    again = np.zeros(len(starts), dtype=bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[a[(b > a)]] = False
    odd_end = ~(_LETTER | _DIGIT | _STOP)[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    # Words that occur earlier in their line.
    line = np.repeat(np.arange(len(a)), b - a)
    key = np.lexsort((hashes, line)) if len(hashes) else np.zeros(0, dtype=np.int64)
    seen = np.zeros(len(hashes), dtype=bool)
    seen[key[1:]] = (hashes[key[1:]] == hashes[key[:-1]]) & (line[key[1:]] == line[key[:-1]])
    letters = np.maximum(marks[1], 1)
    out = np.stack(
        [
            np.ones(len(length)),
            marks[0] / letters,
            *(mark / size for mark in marks[1:]),
            np.log1p(length),
            np.log1p(words),
            np.minimum(letters / many, 30) / 10,
            total(again, a, b) / many,
            total(odd_end, a, b) / many,
            total(seen, a, b) / many,
            (length == 0).astype(float),
            (words == 1).astype(float),
            (marks[0] > 0.8 * letters).astype(float) * (letters > 10),
        ],
        axis=1,
    )
    return out, length + 1, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before and of the line after (zero past the ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:] = x[:-1]
    before[first[:-1]] = 0
    after[:-1] = x[1:]
    after[first[1:] - 1] = 0
    return np.concatenate([x, before, after], axis=1)


def forward_backward(score: np.ndarray, transition: np.ndarray, first: np.ndarray):
    """(log Z per text, P(good) per line, expected transitions) for line scores of good against bad.

    Texts are taken together, step by step, those with more lines first.
    """
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    starts, n = first[:-1][order], n[order]
    alive = np.searchsorted(-n, -np.arange(1, (n.max() if len(n) else 0) + 1), side="right")
    emit = np.stack([np.zeros_like(score), score], axis=1)
    alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
    for t, m in enumerate(alive):
        at = starts[:m] + t
        if t == 0:
            alpha[at] = emit[at]
        else:
            alpha[at] = emit[at] + np.logaddexp(alpha[at - 1, :1] + transition[0], alpha[at - 1, 1:] + transition[1])
    for t in range(len(alive) - 2, -1, -1):
        at = starts[: alive[t + 1]] + t
        ahead = emit[at + 1] + beta[at + 1]
        beta[at] = np.logaddexp(transition[:, 0] + ahead[:, :1], transition[:, 1] + ahead[:, 1:])
    total = np.logaddexp(*alpha[first[1:] - 1].T)
    each = np.repeat(total, np.diff(first))
    good = np.exp(alpha[:, 1] + beta[:, 1] - each)
    inner = np.ones(len(score), dtype=bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    pairs = alpha[at - 1][:, :, None] + transition + (emit[at] + beta[at])[:, None, :] - each[at][:, None, None]
    return total, good, np.exp(pairs).sum(axis=0)


@dataclass
class Crf:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    transition: np.ndarray

    def line_scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.scale
        x[:, 0] = 1
        return with_neighbours(x, first) @ self.weight

    def document_scores(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        x, length, first = line_features(offsets, data)
        _, good, _ = forward_backward(self.line_scores(x, first), self.transition, first)
        return np.add.reduceat(good * length, first[:-1]) / np.add.reduceat(length, first[:-1])


def train(x: np.ndarray, first: np.ndarray, label: np.ndarray, iterations: int = ITERATIONS, decay: float = 1e-3) -> Crf:
    """Maximum likelihood by full-batch Adam; ``label`` is 0 or 1 per text. Both labels must occur."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - mean) / scale
    z[:, 0] = 1
    z = with_neighbours(z, first)
    n = np.diff(first)
    y = np.repeat(label, n).astype(np.float64)
    stays = np.array([[(n[label == 0] - 1).sum(), 0], [0, (n[label == 1] - 1).sum()]], dtype=np.float64)
    theta = np.zeros(z.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, iterations + 1):
        transition = theta[-4:].reshape(2, 2)
        _, good, moved = forward_backward(z @ theta[:-4], transition, first)
        gradient = np.concatenate([z.T @ (y - good), (stays - moved).ravel()]) / len(label) - decay * theta
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Crf(mean, scale, theta[:-4], theta[-4:].reshape(2, 2))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _features(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        rows, blobs = [], []
        for row, offsets, data in text_slices(batch.column("text")):
            x, _, first = line_features(offsets, data)
            for i in range(len(first) - 1):
                if first[i + 1] - first[i] <= most:
                    rows.append(row + i)
                    blobs.append(x[first[i] : first[i + 1]].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("label").take(pa.array(rows, pa.int64())), pa.array(blobs, pa.binary())], names=["label", "x"]
        )


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    train_docs: int = TRAIN_DOCS,
    train_lines: int = TRAIN_LINES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Crf | None:
    """Train on at most ``train_docs`` labelled documents outside the held-out fold, of ``train_lines`` lines at most each.

    Only id and text are read of the documents. Null labels are left out. None
    if there are no documents of both labels.
    """
    prepare(docs.sparkSession)  # the features are computed by this package's code on the workers
    chosen = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col(id_col)) & F.col(id_col).isNotNull())
    chosen = chosen.select(F.col(id_col).alias("doc_id"), F.col("quality").cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(train_docs)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select("label", "text")
    rows = sample.mapInArrow(partial(_features, most=train_lines), "label int, x binary").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["x"])))
    if len({r["label"] for r in rows}) < 2:
        return None
    parts = [np.frombuffer(r["x"]).reshape(-1, FEATURES) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return train(np.concatenate(parts), first, np.array([r["label"] for r in rows]))


def score_quality(
    docs: DataFrame, model: Crf | None, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs`` and held_out, score, predicted (which replace columns of these names).

    score is between 0 and 1, larger where the text is likelier good; null and
    empty texts are one empty line. Without a model every score is 0.5. Rows
    with null or repeated ids are scored like others. predicted is 1 from
    ``threshold`` on.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    at = keep.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for batch in small(batches):
            scores = np.full(batch.num_rows, 0.5)
            if crf is not None:
                for row, offsets, data in text_slices(batch.column(at)):
                    scores[row : row + len(offsets) - 1] = crf.document_scores(offsets, data)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.clip(scores, 0, 1))], names=[*keep, "score"])

    schema = docs.select(*keep).schema.add("score", "double")
    scored = docs.select(*keep).mapInArrow(run, schema)
    return scored.withColumns({"held_out": held_out(F.col(id_col)), "predicted": (F.col("score") >= threshold).cast("int")})
