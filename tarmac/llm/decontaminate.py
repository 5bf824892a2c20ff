"""Benchmark decontamination: broadcast windows of test items, scan training text, verify, remove.

A window is ``window`` consecutive words of an item; a shorter item is one window. Words are runs
of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased.

The hashes of all windows go to every task: an item set of known size is cut into blocks of about
``block_words`` words, so what is broadcast has a bound and a larger set takes more scans. A task
hashes every window of its texts at once, and compares the words of each hash that is found.

Null text has no words. Items that repeat count by their ids; a null item id is never listed but
its windows count. Every input row gives a row, whatever its id; empty tables give empty results.
Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import wordhash
from tarmac.llm.shared import text_column, worker_table

WINDOW = 13
#: Words of items that one scan looks for: some tens of MB in each Python worker.
BLOCK_WORDS = 400_000
_BITS = 22

SPANS = "array<struct<first: bigint, last: bigint>>"
HITS = f"n_words long, hits {SPANS}, items array<string>"


class ItemWindows:
    """The windows of some items: per length a sorted array of hashes, and what they stand for."""

    def __init__(self, items: list[tuple[list[str], str]], window: int):
        """``items`` are the ids of each text, and the text."""
        self.found: dict[int, dict[int, list[tuple[bytes, set[str]]]]] = {}
        column = pa.array([text for _, text in items], pa.string())
        for row, data, offsets in wordhash.text_slices(column):
            words = wordhash.Words(data, offsets, wordhash.ALPHANUMERIC)
            hashes = words.hashes()
            for k in range(len(offsets) - 1):
                first, last = int(words.first[k]), int(words.first[k + 1])
                if first == last:
                    continue
                n = min(window, last - first)
                by_hash = self.found.setdefault(n, {})
                for i, h in enumerate(wordhash.sequence_hashes(hashes[first:last], n)):
                    text = words.text(first + i, first + i + n)
                    entries = by_hash.setdefault(int(h), [])
                    ids = next((ids for known, ids in entries if known == text), None)
                    if ids is None:
                        entries.append((text, ids := set()))
                    ids.update(items[row + k][0])
        self.bitmaps = {}
        for n, by_hash in self.found.items():
            bitmap = np.zeros(1 << _BITS, dtype=bool)
            bitmap[np.fromiter(by_hash, np.uint64, len(by_hash)) >> np.uint64(64 - _BITS)] = True
            self.bitmaps[n] = bitmap

    def scan(self, words: wordhash.Words) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, length, item ids) of every window found, in words of the slice."""
        hashes = words.hashes()
        for n, by_hash in self.found.items():
            runs = wordhash.sequence_hashes(hashes, n)
            for i in np.flatnonzero(self.bitmaps[n][runs >> np.uint64(64 - _BITS)]):
                entries = by_hash.get(int(runs[i]))
                if entries is None:
                    continue
                text_of = int(np.searchsorted(words.first, i, side="right")) - 1
                if i + n > words.first[text_of + 1]:
                    continue
                text = words.text(i, i + n)
                for known, ids in entries:
                    if known == text:
                        yield int(i), n, ids


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (first, last not included) without overlaps, in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _rows(windows: ItemWindows, column: pa.Array) -> Iterator[tuple[int, list, list]]:
    for _, data, offsets in wordhash.text_slices(column):
        words = wordhash.Words(data, offsets, wordhash.ALPHANUMERIC)
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for i, n, ids in windows.scan(words):
            text = int(np.searchsorted(words.first, i, side="right")) - 1
            first = i - int(words.first[text])
            spans.setdefault(text, []).append((first, first + n))
            items.setdefault(text, set()).update(ids)
        for text in range(len(offsets) - 1):
            count = int(words.first[text + 1] - words.first[text])
            yield count, merged(spans.get(text, [])), sorted(items.get(text, ()))


def find_windows(
    documents: DataFrame,
    items: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``keep`` columns of each document with n_words, the spans of words hit, and the item ids."""
    # Items of one text are one, however often it is repeated.
    bare = items.select(
        F.col(item_id).cast("string").alias("id"), text_column(items, item_text).alias("words")
    ).where("words <> ''").groupBy("words").agg(F.collect_set("id").alias("ids"))
    size = bare.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 / block_words))  # a word and its blank: two characters
    rows = documents.select(*keep, text_column(documents, text).alias("__text"))
    if blocks == 1:
        return _scan(rows, keep, bare, window)
    # Hits are those of the text, so two hashes of it stand for the row.
    keys = ["__key_1", "__key_2"]
    rows = rows.select(
        *keep,
        F.xxhash64("__text").alias("__key_1"),
        F.xxhash64(F.lit(1), "__text").alias("__key_2"),
        "__text",
    )
    scans = []
    for b in range(blocks):
        own = bare.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b)
        scans.append(_scan(rows, [*keep, *keys] if b == 0 else keys, own, window))
    found = [s.where("size(hits) > 0").select(*keys, "hits", "items") for s in scans]
    hits = reduce(DataFrame.unionByName, found).groupBy(*keys).agg(
        F.flatten(F.collect_set("hits")).alias("__hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("__items"),
    )
    joined = scans[0].drop("hits", "items").join(hits, keys, "left")
    return _with_merged_spans(
        joined.select(
            *keep,
            "n_words",
            F.coalesce("__hits", F.expr(f"cast(array() as {SPANS})")).alias("hits"),
            F.coalesce("__items", F.expr("cast(array() as array<string>)")).alias("items"),
        )
    )


def _with_merged_spans(df: DataFrame) -> DataFrame:
    """Unites the spans of several scans, which may overlap."""
    at = df.columns.index("hits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at)
            spans = [merged([(s["first"], s["last"]) for s in x]) for x in old.to_pylist()]
            new = pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], old.type)
            yield batch.set_column(at, "hits", new)

    return df.mapInArrow(run, df.schema)


def _scan(rows: DataFrame, keep: list[str], items: DataFrame, window: int) -> DataFrame:
    """One pass over ``rows`` (kept columns and __text) for the windows of ``items``."""
    kept = rows.select(*keep, "__text")
    names = kept.columns[:-1]
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]
    ) + f", {HITS}"
    windows = rows.sparkSession.sparkContext.broadcast(
        ItemWindows([(r.ids, r.words) for r in items.collect()], window)
    )
    span = pa.list_(pa.struct({"first": pa.int64(), "last": pa.int64()}))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_table("decontaminate")
        for batch in batches:
            if not batch.num_rows:
                continue
            counts, spans, ids = zip(*_rows(windows.value, batch.column(len(names))))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(names)],
                    pa.array(counts, pa.int64()),
                    pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], span),
                    pa.array(ids, pa.list_(pa.string())),
                ],
                names=[*names, "n_words", "hits", "items"],
            )

    return kept.mapInArrow(scan, schema)


def contamination(hits: DataFrame, share: float = 0.05) -> DataFrame:
    """Adds n_hit, n_items, items_sha256 and contaminated to what ``find_windows`` returns.

    A document is contaminated if its hit words are at least ``share`` of all its words.
    """
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return (
        hits.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256))
        .withColumn(
            "contaminated",
            (F.col("n_hit") > 0)
            & (F.col("n_hit") * F.lit(round(1 / share)) >= F.col("n_words")),
        )
    )


def remove_contaminated(
    documents: DataFrame, items: DataFrame, text: str = "text", share: float = 0.05, **options
) -> DataFrame:
    """The documents that are not contaminated, with all their columns and their whole texts."""
    marked = documents.select(
        F.struct(*documents.columns).alias("__row"), text_column(documents, text).alias("__words")
    )
    found = contamination(
        find_windows(marked, items, ["__row"], text="__words", **options), share
    )
    return found.where(~F.col("contaminated")).select("__row.*")
