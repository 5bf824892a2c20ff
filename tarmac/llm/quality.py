"""Quality by a linear-chain conditional random field over the lines of a document.

Every line is good or bad. Its potentials come from features of its own form (symbols, digits,
capitals, repeated words, word and line lengths) and from those of the lines beside it; a transition matrix
ties neighbours together. Forward and backward messages give each line's marginal, and their mean
weighted by line length is the document's quality.

Training lines take the label of their document. The model is fitted on at most ``sample_docs``
labelled documents, those with the smallest hash of their id; it is of fixed size. Scoring covers
every row and the whole text in one pass without a shuffle.

Lines end at a line break; blank lines count as lines of length 1. Null and empty text has one
empty line, and scores as the field scores that line. Without labelled documents every score is
0.5. Each input row gives one row, repeated and null ids included. Only the named columns are
read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import wordhash
from tarmac.llm.shared import text_column, worker_table
from tarmac.llm.toxicity import training_sample

#: The bound of the training sample, in documents.
SAMPLE_DOCS = 4_000
#: Lines of a text that is learnt from.
SAMPLE_LINES = 2_000


def _class(characters: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(characters)).astype(np.uint8)


_LOWER, _UPPER = _class(bytes(range(97, 123))), _class(bytes(range(65, 91)))
_DIGIT, _STOP = _class(b"0123456789"), _class(b".!?")
_MARK = _class(b",;:'\"()-")
_SYMBOL = _class(bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in b".!?,;:'\"()-"))
_FORM = 10
FEATURES = 3 * _FORM + 1


class Lines:
    """Features of the lines of a slice of texts; ``first[d] : first[d + 1]`` are those of text d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        texts = len(offsets) - 1
        breaks = np.flatnonzero(data == 10)
        # A line starts with each text and after each break; the end of a text ends its last line.
        start = np.concatenate([offsets[:-1], breaks + 1])
        owner = np.concatenate(
            [np.arange(texts), np.searchsorted(offsets, breaks, side="right") - 1]
        )
        order = np.lexsort((start, owner))
        start, owner = start[order], owner[order]
        self.first = np.searchsorted(owner, np.arange(texts + 1))
        end = np.append(start[1:] - 1, 0)
        end[self.first[1:] - 1] = offsets[1:]
        self.length = np.maximum(end - start, 1)
        self.x = self._features(data, offsets, start, end, owner)

    def _features(self, data, offsets, start, end, owner) -> np.ndarray:
        def count(marks: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
            return (sums[end] - sums[start]).astype(np.float64)

        words = wordhash.Words(data, offsets, wordhash.BLANK_SEPARATED)
        hashes = words.hashes()
        again = np.zeros(len(hashes) + 1, dtype=np.int64)
        if len(hashes) > 1:
            np.cumsum(hashes[1:] == hashes[:-1], out=again[2:])
        a, b = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
        n = np.maximum((b - a).astype(np.float64), 1)
        repeated = np.where(b > a, again[b] - again[np.minimum(a + 1, b)], 0)
        size = self.length.astype(np.float64)
        form = np.stack(
            [
                np.log1p(size),
                np.log1p(n),
                size / n / 10,
                count(_SYMBOL[data]) / n,
                count(_DIGIT[data]) / size,
                count(_UPPER[data]) / n,
                count(_STOP[data]) / n,
                count(_MARK[data]) / n,
                repeated / n,
                (count(_LOWER[data]) + count(data >= 128)) / size,
            ],
            axis=1,
        )
        form[:, 3:] = np.minimum(form[:, 3:], 3.0)
        before, after = np.zeros_like(form), np.zeros_like(form)
        same = owner[1:] == owner[:-1]
        before[1:][same] = form[:-1][same]
        after[:-1][same] = form[1:][same]
        return np.concatenate([form, before, after, np.ones((len(form), 1))], axis=1)


class Field:
    """The fitted field: standardised features, weights of the state "good", and transitions."""

    def __init__(self, mean, scale, weights, transition):
        self.mean, self.scale, self.weights, self.transition = mean, scale, weights, transition

    def potentials(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.weights, -30, 30)

    def scores(self, lines: Lines) -> np.ndarray:
        """The quality of each text."""
        good, _ = marginals(self.potentials(lines.x), lines.first, self.transition)
        weight = lines.length.astype(np.float64)
        total = np.add.reduceat(weight, lines.first[:-1])
        return np.clip(np.add.reduceat(good * weight, lines.first[:-1]) / total, 0.0, 1.0)


def marginals(
    potential: np.ndarray, first: np.ndarray, transition: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """P(line is good), and per sequence the expected counts of the four transitions.

    ``potential`` is the log-odds of "good" of every line; all sequences take a step at once, the
    longest first, so the work is that of the lines.
    """
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    p = 1 / (1 + np.exp(-potential))
    emit = np.stack([1 - p, p], axis=1)
    step = np.exp(transition)
    forward, scale = np.zeros_like(emit), np.ones(len(potential))
    alive = np.searchsorted(-length, -np.arange(1, length.max(initial=0) + 1), side="right")
    message = np.full((len(length), 2), 0.5)
    for t, k in enumerate(alive):
        at = begin[:k] + t
        f = emit[at] * (message[:k] if t == 0 else message[:k] @ step)
        scale[at] = f.sum(axis=1)
        message = f / scale[at][:, None]
        forward[at] = message
    backward = np.ones_like(emit)
    pairs = np.zeros((len(length), 2, 2))
    for t in range(len(alive) - 2, -1, -1):
        k = alive[t + 1]
        at = begin[:k] + t
        ahead = emit[at + 1] * backward[at + 1] / scale[at + 1][:, None]
        backward[at] = ahead @ step.T
        pairs[:k] += forward[at][:, :, None] * step[None] * ahead[:, None, :]
    both = forward * backward
    unsorted = np.empty_like(pairs)
    unsorted[order] = pairs
    return both[:, 1] / both.sum(axis=1), unsorted


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, rounds: int = 150) -> Field:
    """Maximum likelihood with a small ridge, by Adam; every line has its document's label."""
    if not len(label):
        return Field(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)))
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[-1], scale[scale < 1e-9] = 0.0, 1.0
    z = (x - mean) / scale
    length = np.diff(first)
    y = np.repeat(label, length).astype(np.float64)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label, label), np.maximum(length - 1, 0))
    theta = np.zeros(FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        field = Field(mean, scale, theta[:FEATURES], theta[FEATURES:].reshape(2, 2))
        good, pairs = marginals(np.clip(z @ field.weights, -30, 30), first, field.transition)
        grad = np.concatenate([z.T @ (good - y), (pairs.sum(axis=0) - seen).reshape(-1)]) / len(y)
        grad += 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta -= 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return Field(mean, scale, theta[:FEATURES], theta[FEATURES:].reshape(2, 2))


def line_count(text: Column) -> Column:
    """How many lines a text has."""
    return F.length(text) - F.length(F.translate(text, "\n", "")) + 1


def train(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_docs: int = SAMPLE_DOCS,
    sample_lines: int = SAMPLE_LINES,
) -> Field:
    """Learn from labelled documents; the driver gets numbers per line of the sample only."""
    sample = training_sample(
        documents, labels, doc_id, text, label, sample_docs, line_count, sample_lines
    )

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in wordhash.text_slices(batch.column(1)):
                found = Lines(data, offsets)
                x = found.x.astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(offsets) - 1),
                        pa.array(
                            [x[a:b].tobytes() for a, b in zip(found.first, found.first[1:])],
                            pa.binary(),
                        ),
                    ],
                    names=["label", "lines"],
                )

    rows = sample.mapInArrow(lines, "label int, lines binary").collect()
    rows = sorted(rows, key=lambda r: (r.label, r.lines))
    x = [np.frombuffer(r.lines, np.float32).reshape(-1, FEATURES) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(a) for a in x])]).astype(np.int64)
    flat = np.concatenate([*x, np.zeros((0, FEATURES), np.float32)]).astype(np.float64)
    return fit(flat, first, np.array([r.label for r in rows], dtype=np.int64))


def score(documents: DataFrame, field: Field, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with score (0 to 1) and n_lines."""
    shared = documents.sparkSession.sparkContext.broadcast(field)
    rows = documents.select(*keep, text_column(documents, text).alias("__text"))
    names = rows.columns[:-1]
    schema = ", ".join(
        [
            *(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]),
            "score double, n_lines long",
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_table("quality")
        for batch in batches:
            if not batch.num_rows:
                continue
            scores, counts = [], []
            for _, data, offsets in wordhash.text_slices(batch.column(len(names))):
                lines = Lines(data, offsets)
                scores.append(shared.value.scores(lines))
                counts.append(np.diff(lines.first))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(names)],
                    pa.array(np.concatenate(scores)),
                    pa.array(np.concatenate(counts), pa.int64()),
                ],
                names=[*names, "score", "n_lines"],
            )

    return rows.mapInArrow(run, schema)


def keep_good(
    documents: DataFrame, field: Field, text: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The documents of quality ``threshold`` and more, with all their columns."""
    marked = documents.select(
        F.struct(*documents.columns).alias("__row"), text_column(documents, text).alias("__text")
    )
    scored = score(marked, field, ["__row"], "__text").where(F.col("score") >= threshold)
    return scored.select("__row.*")
