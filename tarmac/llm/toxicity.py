"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

Each sentence gets a logistic score from its hashed words and word beginnings; the noisy-or
``1 - prod(1 - p)`` of its sentences is the document's score. Only documents carry labels, so the
loss is that of the noisy-or, and its gradient finds the sentences that explain a label. A scored
document names its worst sentence.

The model is fitted on at most ``sample_docs`` labelled documents, those with the smallest hash
of their id, and is of fixed size. All else covers every row and whole texts, in one pass
without a shuffle. Words are runs of ASCII letters and digits and anything beyond ASCII, A-Z
lower-cased; sentences end with ``. ! ?`` or a line break.

Null and empty text, or text without words, has no sentence and scores 0. Without any labelled
document every score is 0. Each input row gives one row, repeated and null ids included. Only the
named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import wordhash
from tarmac.llm.shared import text_column

#: The bound of the training sample, in documents.
SAMPLE_DOCS = 6_000
#: Words, about, of a text that is learnt from.
SAMPLE_WORDS = 10_000
#: Hashed features; word beginnings of these lengths are features beside the whole word.
BUCKET_BITS = 18
PREFIXES = (4, 5)
_SENTENCE_END = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])


class Sentences:
    """The sentences of a slice of texts: hashed features, their sentence, and the text of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = wordhash.Words(data, offsets, wordhash.ALPHANUMERIC)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
        ends = np.cumsum(_SENTENCE_END[data], dtype=np.int64) if len(data) else np.zeros(0, np.int64)
        number = ends[words.start] if len(words.start) else np.zeros(0, np.int64)
        fresh = np.ones(len(text), dtype=bool)
        fresh[1:] = (number[1:] != number[:-1]) | (text[1:] != text[:-1])
        self.sentence = np.cumsum(fresh) - 1  # of each word
        self.head = np.flatnonzero(fresh)  # first word of each sentence
        self.text = text[self.head]
        shift = np.uint64(64 - BUCKET_BITS)
        hashes = [words.hashes(), *(words.prefix_hashes(n) for n in PREFIXES)]
        self.features = [(h >> shift).astype(np.int32) for h in hashes]
        self.counted = np.ones(len(text), dtype=np.float32)  # a word that repeats the one before is not
        self.counted[1:] = (hashes[0][1:] != hashes[0][:-1]) | fresh[1:]
        self.words = words

    def __len__(self) -> int:
        return len(self.head)


class Model:
    """A weight per hashed feature and a bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias

    def logits(self, s: Sentences) -> np.ndarray:
        per_word = sum(self.weights[f] for f in s.features) * s.counted
        return self.bias + np.add.reduceat(per_word, s.head).astype(np.float64)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def fit(
    label: np.ndarray,
    sentences: np.ndarray,
    words: np.ndarray,
    features: np.ndarray,
    rounds: int = 100,
    l1: float = 4e-4,
) -> Model:
    """Fit on labelled documents; full-batch AdaGrad with soft thresholding.

    ``sentences`` counts those of each document, ``words`` the words of each sentence, and
    ``features`` has a row for each word.
    """
    weights = np.zeros(1 << BUCKET_BITS)
    if not len(label):
        return Model(weights, -20.0)
    doc = np.repeat(np.arange(len(label), dtype=np.int32), sentences)
    # Features of fewer than three documents teach nothing that holds elsewhere.
    in_docs = np.zeros(len(weights), dtype=np.int32)
    first = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=words, minlength=len(label)))])
    for a, b in zip(first[:-1].astype(int), first[1:].astype(int)):
        in_docs[np.unique(features[a:b])] += 1
    useful = np.flatnonzero(in_docs >= 3)
    place = np.full(len(weights), -1, dtype=np.int32)
    place[useful] = np.arange(len(useful))
    owner = np.repeat(np.arange(len(words), dtype=np.int32), words * features.shape[1])
    flat = place[features.reshape(-1)]
    owner, flat = owner[flat >= 0], flat[flat >= 0]
    w, b = np.zeros(len(useful)), -9.5
    sum_w, sum_b = np.full(len(useful), 1e-8), 1e-8
    for _ in range(rounds):
        z = b + np.bincount(owner, weights=w[flat], minlength=len(words))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.bincount(doc, weights=softplus(z), minlength=len(label))  # -log Q
        pull = np.where(label == 1, -1 / np.expm1(np.clip(none, 1e-6, 50)), 1.0) / len(label)
        g = pull[doc] * p
        grad_w, grad_b = np.bincount(flat, weights=g[owner], minlength=len(useful)), g.sum()
        sum_w += grad_w**2
        sum_b += grad_b**2
        step = 0.5 / np.sqrt(sum_w)
        w -= step * grad_w
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b -= 0.6 * grad_b / np.sqrt(sum_b)
    weights[useful] = w
    return Model(weights, b)


def word_count(text: Column) -> Column:
    """About how many words a text has: its blanks and breaks, and one."""
    return F.length(text) - F.length(F.translate(text, " \t\n\r", "")) + 1


def training_sample(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str,
    text: str,
    label: str,
    size: int,
    units: Callable[[Column], Column],
    most: int,
) -> DataFrame:
    """(label, text) of the ``size`` labelled ids with the smallest hash, whatever rows repeat.

    An id with several labels has the smallest, with several texts that of the smallest hash. A
    text of more than ``most`` ``units`` (lines, or words) teaches nothing, which bounds the sample.
    """
    chosen = (
        labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label"))
        .where("__id is not null and __label in (0, 1)")
        .groupBy("__id")
        .agg(F.min("__label").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(size)
    )
    texts = documents.select(F.col(doc_id).alias("__id"), text_column(documents, text).alias("text"))
    texts = texts.where(units(F.col("text")) <= most).join(F.broadcast(chosen), "__id")
    once = texts.groupBy("__id").agg(
        F.min("__label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text")
    )
    return once.select("label", "text")


def train(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_docs: int = SAMPLE_DOCS,
    sample_words: int = SAMPLE_WORDS,
) -> Model:
    """Learn from labelled documents; tasks hash the texts, the driver gets features only."""
    sample = training_sample(
        documents, labels, doc_id, text, label, sample_docs, word_count, sample_words
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in wordhash.text_slices(batch.column(1)):
                s = Sentences(data, offsets)
                words = np.bincount(s.text, minlength=len(offsets) - 1)
                n = np.diff(np.append(s.head, len(s.sentence))).astype(np.int32)
                first = np.concatenate([[0], np.cumsum(words)])
                packed = np.stack(s.features, axis=1) if len(s) else np.zeros((0, 3), np.int32)
                starts = np.append(s.head, len(s.sentence))
                labels_ = batch.column(0).slice(row, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        labels_,
                        pa.array([n[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary()),
                        pa.array(
                            [packed[starts[a] : starts[b]].tobytes() for a, b in zip(first, first[1:])],
                            pa.binary(),
                        ),
                    ],
                    names=["label", "words", "features"],
                )

    table = sample.mapInArrow(hashed, "label int, words binary, features binary").toArrow()
    table = table.sort_by([("label", "ascending"), ("features", "ascending")])
    words = [np.frombuffer(x.as_buffer(), np.int32) for x in table["words"]]
    features = b"".join(x.as_py() for x in table["features"])
    return fit(
        table["label"].to_numpy(),
        np.array([len(x) for x in words], dtype=np.int64),
        np.concatenate([*words, np.zeros(0, np.int32)]),
        np.frombuffer(features, np.int32).reshape(-1, 1 + len(PREFIXES)),
    )


def score(documents: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with score and the worst sentence: its text's bytes and its probability."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(*keep, text_column(documents, text).alias("__text"))
    names = rows.columns[:-1]
    added = "score double, worst_first long, worst_bytes long, worst_score double"
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), added]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [
                _score_slice(shared.value, data, offsets)
                for _, data, offsets in wordhash.text_slices(batch.column(len(names)))
            ]
            columns = [np.concatenate(x) for x in zip(*parts)]
            missing = columns[1] < 0
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(names)],
                    pa.array(columns[0]),
                    pa.array(columns[1], pa.int64(), mask=missing),
                    pa.array(columns[2], pa.int64(), mask=missing),
                    pa.array(columns[3], pa.float64(), mask=missing),
                ],
                names=[*names, "score", "worst_first", "worst_bytes", "worst_score"],
            )

    return rows.mapInArrow(run, schema)


def _score_slice(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    texts = len(offsets) - 1
    total, worst = np.zeros(texts), np.zeros(texts)
    first, size = np.full(texts, -1, np.int64), np.zeros(texts, np.int64)
    s = Sentences(data, offsets)
    if len(s):
        z = model.logits(s)
        total = np.bincount(s.text, weights=softplus(z), minlength=texts)
        order = np.lexsort((-np.arange(len(z)), z, s.text))  # the last of a text: highest, then first
        last = order[np.flatnonzero(np.append(np.diff(s.text[order]) > 0, True))]
        ends = np.append(s.head[1:], len(s.sentence)) - 1
        of = s.text[last]
        first[of] = s.words.start[s.head[last]] - offsets[of]
        size[of] = s.words.end[ends[last]] - s.words.start[s.head[last]]
        worst[of] = np.exp(-softplus(-z[last]))
    return 1 - np.exp(-total), first, size, worst
