"""Ranked lexical search by best positions: the highest-scoring documents of each item, proven.

A term weighs floor(1000 ln((2N+2)/(2 df+1))) and gives a document weight * (10^9 tf div
(1000 tf + 20 m)), with m = 100 - 50 + 50 n N div L; N, L, df are counted over all documents
first, in a pass of its own whose output is one row per term and task.

The second pass searches. A task gathers postings of the items' terms in shards of about
``SHARD_POSTINGS``, lists each term's by falling impact, and answers each item by best positions:
blocks of entries are read from all of the item's lists; a document met in any of them is looked up
by direct access in all, which gives its whole score and marks its place in every list; the best
position of a list is the end of its contiguous marked places. A document not yet met has at most
the sum of the impacts at the best positions. The search ends only if that sum is strictly below
the k-th score, so ties stay, or with the lists. The k best of an item are carried from shard to
shard of a task, which makes later searches shorter, and leave the task as k rows. A window over
these keeps k of each item; Spark applies its limit before the shuffle too.

Work is split by documents, so a frequent term or a third of all rows of one source is spread over
tasks, and a lost task is repeated alone. Items go to the tasks in blocks of about ``BLOCK_PAIRS``
distinct (item, term) pairs, which bounds what is broadcast; a larger item set takes more scans.
Terms are found by a hash of 64 bits and then compared byte by byte.

Null text has no terms. Rows of ``items`` with one id, null too, are one item with the terms of all;
an item without terms has no rows. Each row of ``documents`` is ranked, repeated ones too; null ids
come last among equal scores. Empty tables give an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm import wordhash
from tarmac.llm.shared import text_column

K = 50
#: (item, term) pairs that one scan looks for.
BLOCK_PAIRS = 300_000
#: Postings of one search: some 150 MB of arrays.
SHARD_POSTINGS = 1_500_000
#: Entries of each list read at first; every further block is twice as long.
FIRST_BLOCK = 16

#: Terms: runs of ASCII letters and digits and of anything beyond ASCII.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FILTER_BITS = 22


class Vocabulary:
    """Terms by number, found in slices of words."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        column = pa.array(raw, pa.binary())
        hashes = np.zeros(len(raw), dtype=np.uint64)
        for row, data, offsets in wordhash.text_slices(column):
            words = wordhash.Words(data, offsets, wordhash.ALPHANUMERIC)
            hashes[row : row + len(offsets) - 1] = words.hashes()
        self.size = np.array([len(t) for t in raw], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)])
        self.bytes = np.frombuffer(b"".join(raw) + bytes(8), dtype=np.uint8)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        # Several terms of one hash are told apart by their bytes.
        self.most = int(np.unique(hashes, return_counts=True)[1].max()) if len(raw) else 0
        self.maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.maybe[hashes >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, words: wordhash.Words) -> tuple[np.ndarray, np.ndarray]:
        """Words of the slice that are terms, and which."""
        hashes = words.hashes()
        word = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - _FILTER_BITS)])
        place = np.searchsorted(self.hashes, hashes[word])
        found_words, found_terms = [], []
        for further in range(self.most):
            at = np.minimum(place + further, len(self.hashes) - 1)
            same = (self.hashes[at] == hashes[word]) & (place + further < len(self.hashes))
            term = self.order[at[same]]
            equal = self._equal(words, word[same], term)
            found_words.append(word[same][equal])
            found_terms.append(term[equal])
        if not found_words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_words), np.concatenate(found_terms)

    def _equal(self, words: wordhash.Words, word: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Whether words and terms have the same bytes, eight at a time."""
        equal = words.end[word] - words.start[word] == self.size[term]
        if not len(word):
            return equal
        mine = _eights(np.append(words.mapped, np.zeros(8, np.uint8)))
        theirs = _eights(self.bytes)
        for skip in range(0, int(self.size[term].max()), 8):
            some = np.flatnonzero(equal & (self.size[term] > skip))
            rest = np.minimum(self.size[term[some]] - skip, 8).astype(np.uint64)
            unused = (np.uint64(8) - rest) * np.uint64(8)
            a = mine[words.start[word[some]] + skip] << unused
            b = theirs[self.begin[term[some]] + skip] << unused
            equal[some[a != b]] = False
        return equal


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one little-endian number; data ends in eight more."""
    return np.ndarray(len(data) - 7, dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,))


@dataclass
class Counts:
    """N documents with a term, L terms of all documents, and df of each term of the vocabulary."""

    documents: int
    terms: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        n = self.documents
        return np.array(
            [math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in self.df.tolist()],
            dtype=np.int64,
        )


@dataclass
class Postings:
    """Frequencies of the vocabulary's terms in numbered documents, and the lengths of these."""

    document: np.ndarray
    term: np.ndarray
    tf: np.ndarray
    length: np.ndarray


def postings(vocabulary: Vocabulary, texts: pa.Array) -> Iterator[tuple[int, Postings]]:
    """(first row, postings) of slices of texts."""
    for row, data, offsets in wordhash.text_slices(texts):
        words = wordhash.Words(data, offsets, wordhash.ALPHANUMERIC)
        word, term = vocabulary.find(words)
        document = np.searchsorted(words.first, word, side="right") - 1
        size = len(vocabulary.hashes) or 1
        pair, tf = np.unique(document * size + term, return_counts=True)
        yield row, Postings(pair // size, pair % size, tf, np.diff(words.first))


class Lists:
    """The impact lists of one shard, with direct access to any document's place."""

    def __init__(self, document: np.ndarray, term: np.ndarray, impact: np.ndarray, documents: int):
        falling = np.lexsort((document, -impact, term))
        self.document, self.impact = document[falling], impact[falling]
        self.documents = documents
        terms = term[falling]
        self.terms, self.begin = np.unique(terms, return_index=True)
        self.end = np.append(self.begin[1:], len(terms))
        keys = terms * documents + self.document
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]

    def scores(self, terms: np.ndarray, documents: np.ndarray) -> np.ndarray:
        """Direct access to some documents in some terms' lists: their whole scores."""
        wanted = (terms[:, None] * self.documents + documents).reshape(-1)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        impacts = np.where(hit, self.impact[self.by_key[at]], 0)
        return impacts.reshape(len(terms), -1).sum(axis=0)


class Best:
    """The k best documents so far of one item, over all shards of a task."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)
        self.id = np.zeros(0, np.int64)

    def add(self, score: np.ndarray, null: np.ndarray, key: np.ndarray) -> None:
        enough = score >= max(1, self.floor())
        score = np.concatenate([self.score, score[enough]])
        null = np.concatenate([self.null, null[enough]])
        key = np.concatenate([self.id, key[enough]])
        order = np.lexsort((key, null, -score))[: self.k]
        self.score, self.null, self.id = score[order], null[order], key[order]

    def floor(self) -> int:
        """The k-th score; 0 while there are fewer."""
        return int(self.score[-1]) if len(self.score) == self.k else 0


def search(lists: Lists, terms: np.ndarray, best: Best, null: np.ndarray, ids: np.ndarray) -> int:
    """Improves ``best`` by the shard's documents; returns how many entries were read."""
    terms = terms[np.isin(terms, lists.terms)]
    which = np.searchsorted(lists.terms, terms)
    begin, end = lists.begin[which], lists.end[which]
    position = begin.copy()
    # Before anything is read, no document can have more than the sum of the highest impacts.
    bound = int(lists.impact[begin].sum())
    seen = np.zeros(lists.documents, dtype=bool)
    read, block = 0, FIRST_BLOCK
    while len(terms) and bound > 0 and bound >= best.floor():
        parts = [lists.document[p : min(p + block, e)] for p, e in zip(position, end)]
        met = np.unique(np.concatenate(parts))
        read += sum(map(len, parts))
        met = met[~seen[met]]
        seen[met] = True
        best.add(lists.scores(terms, met), null[met], ids[met])
        bound = 0
        for i, (p, e) in enumerate(zip(position.tolist(), end.tolist())):
            p = position[i] = _first_unseen(lists.document, seen, p, e, block)
            if p < e:
                bound += int(lists.impact[p - 1])
        block *= 2
    return read


def _first_unseen(document: np.ndarray, seen: np.ndarray, place: int, end: int, step: int) -> int:
    """The place behind the contiguous seen ones."""
    while place < end:
        marks = seen[document[place : min(place + step, end)]]
        first = int(marks.argmin())
        if not marks[first]:
            return place + first
        place += len(marks)
        step *= 2
    return end


def count_terms(documents: DataFrame, text: str, vocabulary) -> Counts:
    """The counts of one block's vocabulary (broadcast) over all documents."""
    rows = documents.select(text_column(documents, text).alias("__text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        df = np.zeros(len(words.hashes), dtype=np.int64)
        n = total = 0
        for batch in batches:
            for _, found in postings(words, batch.column(0)):
                df += np.bincount(found.term, minlength=len(df))
                n += int((found.length > 0).sum())
                total += int(found.length.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-2, -1, *some.tolist()], pa.int64()),
                pa.array([n, total, *df[some].tolist()], pa.int64()),
            ],
            names=["term", "n"],
        )

    sums = rows.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in sums.collect()}
    size = len(vocabulary.value.hashes)
    df = np.array([found.get(t, 0) for t in range(size)], dtype=np.int64)
    return Counts(found.get(-2, 0), found.get(-1, 0), df)


def _task_bests(
    rows: DataFrame, vocabulary, counts: Counts, items: list[tuple], k: int, item_type: str
) -> DataFrame:
    """The k best of each item among each task's documents."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((counts.weights(), items))
    n_all, l_all = counts.documents, counts.terms
    key_type = rows.schema[0].dataType.simpleString()
    schema = f"item int, doc_id {key_type}, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, wanted = shared.value
        bests = [Best(k) for _ in wanted]
        held: list[tuple] = []
        size = 0
        arrow_type = None

        def close() -> None:
            lengths = np.concatenate([h[3] for h in held])
            starts = np.cumsum([0, *(len(h[3]) for h in held)])
            document = np.concatenate([h[0] + s for h, s in zip(held, starts)])
            term = np.concatenate([h[1] for h in held])
            tf = np.concatenate([h[2] for h in held]).astype(np.int64)
            null = np.concatenate([h[4] for h in held])
            ids = np.concatenate([h[5] for h in held])
            m = 50 + 50 * lengths.astype(np.int64) * n_all // max(l_all, 1)
            impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[document]))
            some = impact > 0
            if some.any():
                lists = Lists(document[some], term[some], impact[some], len(lengths))
                for (_, terms), best in zip(wanted, bests):
                    search(lists, terms, best, null, ids)
            held.clear()

        for batch in batches:
            arrow_type = batch.column(0).type
            keys = batch.column(0)
            null = keys.is_null().to_numpy(zero_copy_only=False)
            ids = keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for row, found in postings(vocabulary.value, batch.column(1)):
                own = slice(row, row + len(found.length))
                held.append(
                    (found.document, found.term, found.tf, found.length, null[own], ids[own])
                )
                size += len(found.document)
                if size >= SHARD_POSTINGS:
                    close()
                    size = 0
        if held:
            close()
        for number, best in enumerate(bests):
            if len(best.score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(best.score), number), pa.int32()),
                        pa.array(best.id, mask=best.null).cast(arrow_type),
                        pa.array(best.score, pa.int64()),
                    ],
                    names=["item", "doc_id", "score"],
                )

    return rows.mapInArrow(run, schema)


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, term) once each, terms with A-Z in lower case."""
    words = F.regexp_extract_all(
        F.translate(text_column(items, text), _UPPER, _LOWER), F.lit(_TERM), F.lit(0)
    )
    pairs = items.select(F.col(item_id).alias("item"), F.explode(F.array_distinct(words)).alias("term"))
    return pairs.distinct()


def search_ranked(
    documents: DataFrame,
    items: DataFrame,
    k: int = K,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank from 1, doc_id, score."""
    context = documents.sparkSession.sparkContext
    pairs = item_terms(items, item_id, item_text)
    blocks = max(1, math.ceil(pairs.count() / block_pairs))
    rows = documents.select(F.col(doc_id), text_column(documents, text).alias("__text"))
    kind = pairs.schema["item"].dataType.simpleString()
    bests = None
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        terms = sorted({r.term for r in own})
        number = {t: i for i, t in enumerate(terms)}
        by_item: dict = {}
        for r in own:
            by_item.setdefault(r.item, []).append(number[r.term])
        wanted = [(item, np.array(sorted(t), dtype=np.int64)) for item, t in by_item.items()]
        vocabulary = context.broadcast(Vocabulary(terms))
        counts = count_terms(documents, text, vocabulary)
        found = _task_bests(rows, vocabulary, counts, wanted, k, kind)
        names = documents.sparkSession.createDataFrame(
            [(i, item) for i, (item, _) in enumerate(wanted)], f"item int, item_id {kind}"
        )
        found = _ranked(found, "item", k).join(F.broadcast(names), "item").drop("item")
        bests = found if bests is None else bests.unionByName(found)
    return bests.select("item_id", "rank", F.col("doc_id"), "score")


def _ranked(found: DataFrame, item: str, k: int) -> DataFrame:
    best_first = Window.partitionBy(item).orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last()
    )
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
