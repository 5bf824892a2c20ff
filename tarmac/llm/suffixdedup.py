"""Removal of byte strings that occur more than once, over a sparse suffix array.

Every byte covered by a string of ``width`` bytes that also starts elsewhere, in this text or any
other, is removed. Strings are judged on the input; they never cross texts.

Only some suffixes are sorted. Each window of ``width`` bytes names the ``gram`` bytes with the
smallest hash in it as its anchor, so equal windows name the same place, and there is about one
anchor in (width - gram) / 2 bytes. All that a window around an anchor can hold is the anchor's
context: ``width - gram`` bytes before it and ``width`` bytes from it on, within the text.

1. Anchors whose gram occurs once in the corpus are done. A bitmap of fixed size keeps them out of
   all further shuffles.
2. Anchors with equal contexts repeat as a whole; these are counted by hash, with map-side
   combining, so groups of copies shrink before the shuffle.
3. Where a gram has different contexts, one anchor of each is kept with its bytes: a task sends a
   context once, and what several tasks sent is dropped as it is read in order. Up to ``group`` of
   them are sorted in a task, the suffixes from the anchor on and the reversed texts before it,
   by deep-shallow sorting: multikey quicksort to a shallow depth, then blind tries. The common
   prefixes of both orders tell how far the string shared with any other reaches.
4. Larger groups are split first: the places that a window may take around the anchor are parted,
   and contexts that share a window of a part agree on the bytes common to its windows. Up to
   ``group`` that agree are sorted as in 3. More are parted again; those that agree on all bytes of
   the windows are decided at once, and one of them stays to meet the others. Until it is sorted a
   context stays where it is: only hashes are shuffled, and bitmaps tell the tasks what they found.

Equal texts are one text; if it is repeated all its windows are. Null and empty text, and text
below ``width`` bytes, has nothing to remove. Repeated rows each get their row, null ids too. Only
the named columns are read. Hashes of 64 bits stand for whole texts and contexts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import deepshallow, wordhash
from tarmac.llm.shared import Stage, key_filter, text_column

WIDTH, GRAM = 200, 32
#: Bytes before and from an anchor are one number, times and plus less than this.
SIDE = 4096
#: Different contexts of a gram that one task sorts.
GROUP = 128
#: Parts of the places of a window, when more contexts agree.
PARTS = 4
#: Keys that a task puts in a filter of one round.
FILTER_KEYS = 1 << 16
#: Bytes of texts whose anchors are found at once; the arrays of so many stay in a core's cache.
SLICE = 1 << 18
#: Contexts that a task remembers to have sent; it forgets them all when there are more.
SENT = 200_000

_KEYS = [f"key{i}" for i in range(PARTS)]
_ORDER_MASK = np.uint64((1 << 36) - 1 << 28)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Anchors:
    """The anchors of a slice of texts, in order: text, position in it, hashes, and context."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, gram: int):
        n = len(data)
        self.data = data
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * wordhash.powers(_BASE, n), out=sums[1:])
        inverse = wordhash.powers(_INVERSE, n + 1)
        grams = max(0, n - gram + 1)
        h = wordhash.mix((sums[gram:] - sums[: grams]) * inverse[:grams]) if grams else sums[:0]
        span = width - gram + 1
        least = h & _ORDER_MASK
        least |= np.arange(grams, dtype=np.uint64)
        reach = 1
        while 2 * reach <= span and len(least) > reach:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if span > reach and len(least) > span - reach:
            least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
        # Of each text its windows, and not those that begin in it and end in another.
        sizes = np.diff(offsets)
        windows = np.maximum(sizes - width + 1, 0)
        inside = np.repeat(np.tile([True, False], len(sizes)), np.stack([windows, sizes - windows], 1).reshape(-1))
        starts = max(0, n - width + 1)
        chosen = least[:starts][inside[:starts]]
        changes = np.ones(len(chosen), dtype=bool)
        np.not_equal(chosen[1:], chosen[:-1], out=changes[1:])
        at = (chosen[changes] & ~_ORDER_MASK).astype(np.int64)
        self.at = at
        self.text = np.searchsorted(offsets, at, side="right") - 1
        first, last = offsets[self.text], offsets[self.text + 1]
        self.position = at - first
        self.gram = h[at].view(np.int64)
        self.left = np.minimum(at - first, width - gram)
        self.right = np.minimum(last - at, width)
        a, b = at - self.left, at + self.right
        context = (sums[b] - sums[a]) * inverse[a]
        size = (self.left * SIDE + self.right).astype(np.uint64)
        self.context = wordhash.mix(context ^ wordhash.mix(size)).view(np.int64)

    def references(self, text_hashes: np.ndarray) -> np.ndarray:
        """A hash of each anchor's text and place in it."""
        of = text_hashes[self.text].view(np.uint64)
        return wordhash.mix(of ^ wordhash.mix(self.position.astype(np.uint64))).view(np.int64)


def _anchors(batch: pa.RecordBatch, width: int, gram: int) -> Iterator[tuple[Anchors, np.ndarray]]:
    hashes = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    for row, data, offsets in wordhash.text_slices(batch.column(1), SLICE):
        own = hashes[row : row + len(offsets) - 1]
        found = Anchors(data, offsets, width, gram)
        if len(found.at):
            yield found, own


def _record(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.split())


def _distinct(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with the smallest and the largest value; two numbers tell whether there are several."""
    return df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def repeated_spans(texts: DataFrame, stage: Stage, width: int, gram: int, group: int) -> DataFrame:
    """(t, spans) of the texts (t, text) with strings of ``width`` bytes that start elsewhere.

    Spans are (first, last) bytes, last not included, unmerged. Rows with equal t count as one.
    """
    spark = texts.sparkSession

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, own in _anchors(batch, width, gram):
                yield _record("gram ref", found.gram, found.references(own))

    every = texts.mapInArrow(grams, "gram long, ref long")
    shared = stage.table("grams", _distinct(every, ["gram"], "ref").where("lo < hi").select("gram"))
    bits = spark.sparkContext.broadcast(key_filter(shared, "gram"))
    stage.drop("grams")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, own in _anchors(batch, width, gram):
                kept = bits.value.maybe(found.gram)
                columns = (
                    found.gram, found.context, found.references(own), own[found.text], found.position
                )
                sides = (found.left * SIDE + found.right)[kept].astype(np.int32)
                yield _record("gram ctx ref t at sides", *(c[kept] for c in columns), sides)

    kinds = "gram long, ctx long, ref long, t long, at long, sides int"
    anchors = stage.table("anchors", texts.mapInArrow(places, kinds))
    bits.destroy()
    # Equal contexts reach equally far to both sides of the anchor.
    contexts = anchors.groupBy("gram", "ctx").agg(
        F.min("ref").alias("lo"), F.max("ref").alias("hi"), F.min("sides").alias("sides")
    )
    contexts = stage.table("contexts", contexts)
    # Grams with several contexts, one of which has a single place; large groups are known in any case,
    # as a filter may let them pass.
    mixed = contexts.groupBy("gram").agg(
        F.count("*").alias("n"), F.max(F.expr("lo = hi")).alias("open")
    )
    mixed = stage.table("mixed", mixed.where(f"n > 1 and open or n > {group}"))
    # A gram that the filter lets pass wrongly has nothing to find: its contexts are alone, or repeat.
    several = spark.sparkContext.broadcast(key_filter(mixed.where("open"), "gram"))
    chosen = _filtered(contexts.select("gram", F.col("lo").alias("ref")), 0, several)
    wanted = spark.sparkContext.broadcast(key_filter(chosen, "ref"))

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            for found, own in _anchors(batch, width, gram):
                kept = np.flatnonzero(wanted.value.maybe(found.references(own)))
                kept = kept[_unsent(found.gram[kept], found.context[kept], sent)]
                raw = found.data.tobytes()
                a, b = found.at - found.left, found.at + found.right
                pieces = [raw[x:y] for x, y in zip(a[kept].tolist(), b[kept].tolist())]
                yield _record(
                    "gram ctx l bytes big", found.gram[kept], found.context[kept], found.left[kept],
                    pa.array(pieces, pa.binary()), hot.value.maybe(found.gram[kept]),
                )

    # Small groups that the filter takes for large ones are decided as well as those.
    crowded = mixed.where(F.col("n") > group).select("gram")
    hot = spark.sparkContext.broadcast(key_filter(crowded, "gram"))
    pieces = texts.mapInArrow(bytes_of, "gram long, ctx long, l long, bytes binary, big boolean")
    pieces = stage.table("pieces", pieces)
    for used in (several, wanted, hot):
        used.destroy()
    small = (
        pieces.where("not big")
        .select("gram", "ctx", "l", "bytes")
        .repartition("gram")
        .sortWithinPartitions("gram", "ctx")
        .mapInArrow(_sorted_groups(width), "gram long, ctx long, l long, r long")
    )
    whole = contexts.where("lo < hi").select(
        "gram",
        "ctx",
        F.expr(f"sides div {SIDE}").alias("l"),
        (F.col("sides") % SIDE).cast("long").alias("r"),
    )
    reach = whole.unionByName(small)
    for part in _parted(pieces.where("big"), stage, width, gram, group):
        reach = reach.unionByName(part)
    reach = stage.table("reach", reach.where(f"l + r >= {width}"))
    stage.drop("pieces", "mixed", "contexts", *stage.names("sorted-"), *stage.names("sure-"))
    # Only anchors whose context may reach far enough meet the contexts that do.
    far = spark.sparkContext.broadcast(key_filter(reach, "ctx"))
    found = _filtered(anchors.select("ctx", "gram", "t", "at"), 0, far)
    spans = found.join(reach, ["gram", "ctx"])
    # A text has as many spans as repeated anchors; only distinct ones are kept.
    return spans.groupBy("t").agg(
        F.collect_set(
            F.struct((F.col("at") - F.col("l")).alias("first"), (F.col("at") + F.col("r")).alias("last"))
        ).alias("spans")
    )


def _filtered(rows: DataFrame, column: int, *inside) -> DataFrame:
    """The rows whose key in this column may be in some broadcast filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(column).to_numpy(zero_copy_only=False)
            kept = np.ones(len(keys), dtype=bool)
            for bits in inside:
                kept &= bits.value.maybe(keys)
            yield batch.filter(pa.array(kept))

    return rows.mapInArrow(run, rows.schema)


def _unsent(grams: np.ndarray, contexts: np.ndarray, sent: set[tuple[int, int]]) -> np.ndarray:
    """Whether each context comes for the first time; ``sent`` holds those before and is filled."""
    if len(sent) > SENT:
        sent.clear()
    first = np.zeros(len(grams), dtype=bool)
    for i, key in enumerate(zip(grams.tolist(), contexts.tolist())):
        if key not in sent:
            sent.add(key)
            first[i] = True
    return first


def _sorted_groups(width: int):
    """For batches in order of gram and context: how far each context repeats, to either side.

    Groups may be parts of a gram's contexts: the first column names the group, a fifth the gram.
    """

    def solve(rows: list[tuple]) -> list[tuple[int, int, int, int]]:
        if len(rows) < 2:
            return []
        if len(rows) == 2:
            (_, _, l, a, *_), (_, _, m, b, *_) = rows
            x, y = (deepshallow.common_prefix(*p) for p in ((a[:l][::-1], b[:m][::-1]), (a[l:], b[m:])))
            return [(*_of(row), x, y) for row in rows] if x + y >= width else []
        after = deepshallow.common_prefixes([b[l:] for _, _, l, b, *_ in rows])
        before = deepshallow.common_prefixes([b[:l][::-1] for _, _, l, b, *_ in rows])
        enough = after + before >= width
        np.fill_diagonal(enough, False)
        left, right = np.where(enough, before, 0).max(axis=1), np.where(enough, after, 0).max(axis=1)
        return [
            (*_of(row), int(x), int(y))
            for row, x, y in zip(rows, left, right)
            if x + y >= width
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if waiting and waiting[-1][0] != row[0]:
                    out.extend(solve(waiting))
                    waiting = []
                if not waiting or waiting[-1][1] != row[1]:
                    waiting.append(row)
            yield _found(out)
        yield _found(solve(waiting))

    return run


def _of(row: tuple) -> tuple[int, int]:
    """The gram and context of a row of a group."""
    return (row[4] if len(row) > 4 else row[0]), row[1]


def _found(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], names=["gram", "ctx", "l", "r"]
    )


def _parted(pieces: DataFrame, stage: Stage, width: int, gram: int, group: int) -> Iterator[DataFrame]:
    """Reach of the contexts of large groups, by parting the places of a window.

    A window starts ``o`` bytes before the anchor, lo <= o <= hi. All windows of a range share
    the bytes from lo before the anchor to width - hi after it; together they cover those from hi
    before to width - lo after it. Contexts that share a window agree on the former; up to ``group``
    that do are sorted. Contexts of more that agree on the latter are decided. One of them stays,
    closed, to meet the undecided, which may share part of its windows.
    """
    context = pieces.sparkSession.sparkContext

    def bitmap(keys: DataFrame, column: str):
        return context.broadcast(key_filter(keys, column, per_task=FILTER_KEYS))

    columns = ["gram", "ctx", "l", "r", "bytes", "lo", "hi", "open"]
    rows = pieces.dropDuplicates(["gram", "ctx"]).select(
        "gram",
        "ctx",
        "l",
        (F.octet_length("bytes") - F.col("l")).alias("r"),
        "bytes",
        F.lit(0).alias("lo"),
        F.lit(width - gram).alias("hi"),
        F.lit(True).alias("open"),
    )
    rest = stage.table("rest-0", _with_keys(rows, width))
    covered = F.expr(f"substring(bytes, cast(l - hi + 1 as int), hi + {width} - lo)")
    round_ = 0
    while True:
        # Keys are stored beside the contexts, so that counting them reads no bytes.
        keys = rest.select("open", F.explode(F.array(*_KEYS)).alias("key")).where("key is not null")
        keys = keys.groupBy("key").agg(F.count("*").alias("n"), F.max("open").alias("any_open"))
        keys = stage.table("keys", keys.where(f"n > 1 and any_open or n > {group}"))
        # Large ones are known in any case, as the filter of the others may let them pass.
        alive = bitmap(keys.where("any_open"), "key")
        large = bitmap(keys.where(F.col("n") > group), "key")
        more = bool(keys.where(F.col("n") > group).where("any_open").take(1))
        stage.drop("keys")
        few = (
            _dealt(rest, alive, large, small=True)
            .select("key", "ctx", "l", "bytes", "gram")
            .repartition("key")
            .sortWithinPartitions("key", "ctx")
            .mapInArrow(_sorted_groups(width), "gram long, ctx long, l long, r long")
        )
        yield stage.table(f"sorted-{round_}", few)
        if more:
            full = F.expr(f"l >= hi and r >= {width} - lo")
            key = F.when(full, F.xxhash64("gram", "lo", "hi", covered)).otherwise(F.xxhash64("ctx"))
            rows = _dealt(rest, alive, large, small=False).withColumn("key", key)
            rows = stage.table("many", rows)
        alive.destroy()
        large.destroy()
        stage.drop(f"rest-{round_}")
        if not more:
            return
        same = rows.groupBy("key").agg(F.min("ctx").alias("first"), F.max("ctx").alias("last"))
        same = stage.table("same", same.where("first < last").select("key", "first"))
        repeated = bitmap(same, "key")
        # What may be decided is told from the keys, without the bytes.
        told = _filtered(rows.drop("l", "r", "bytes"), 0, repeated).join(same, "key", "left")
        told = stage.table("told", told)
        decided = told.where("first is not null and open").select(
            "gram",
            "ctx",
            F.col("hi").cast("long").alias("l"),
            (F.lit(width) - F.col("lo")).cast("long").alias("r"),
        )
        yield stage.table(f"sure-{round_}", decided)
        own = F.xxhash64("key", "ctx").alias("own")
        loose = bitmap(told.where("first is null").select(own), "own")
        first = bitmap(told.where("ctx = first").select(own), "own")
        rows = _going_on(rows.where("lo < hi").select("key", own, *columns), repeated, loose, first)
        round_ += 1
        rest = stage.table(f"rest-{round_}", _with_keys(rows.drop("key", "own"), width))
        for used in (repeated, loose, first):
            used.destroy()
        stage.drop("many", "same", "told")


def _with_keys(rows: DataFrame, width: int) -> DataFrame:
    """The rows with a key for each part of their places: gram, part, and what its windows share.

    A key is null where the context has no window of the part.
    """
    step = f"cast(ceil((hi - lo + 1) / {PARTS}) as int)"
    keys = {}
    for i, name in enumerate(_KEYS):
        x, y = f"(lo + {i} * {step})", f"least(hi, lo + {i + 1} * {step} - 1)"
        shared = f"substring(bytes, cast(l - {x} + 1 as int), {x} + {width} - {y})"
        keys[name] = F.expr(
            f"if({x} <= {y} and {x} <= l and {y} >= {width} - r, xxhash64(gram, {x}, {y}, {shared}), null)"
        )
    return rows.withColumns(keys)


def _dealt(rest: DataFrame, alive, large, small: bool) -> DataFrame:
    """A row (key, ...) for each part of the contexts whose key is alive, in a small group or a large one.

    Bytes reach a task once for all parts, and leave it for the parts that are wanted.
    """
    columns = [c for c in rest.columns if c not in _KEYS]
    schema = rest.select(F.col(_KEYS[0]).alias("key"), *columns).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, hi = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi"))
            step = -((lo - hi - 1) // PARTS)
            for i, name in enumerate(_KEYS):
                key = batch.column(name)
                there = key.is_valid().to_numpy(zero_copy_only=False)
                key = pc.fill_null(key, 0).to_numpy(zero_copy_only=False)
                at = np.flatnonzero(there & alive.value.maybe(key) & (large.value.maybe(key) != small))
                part = batch.select(columns).take(pa.array(at))
                ends = {"lo": lo + i * step, "hi": np.minimum(hi, lo + (i + 1) * step - 1)}
                values = [
                    pa.array(ends[c][at], pa.int32()) if c in ends else part.column(c) for c in columns
                ]
                yield pa.RecordBatch.from_arrays([pa.array(key[at]), *values], names=schema.names)

    return rest.mapInArrow(run, schema)


def _going_on(rows: DataFrame, repeated, loose, first) -> DataFrame:
    """The undecided rows (key, own, ...), and the first of each decided class, which is closed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            undecided = ~repeated.value.maybe(key) | loose.value.maybe(own)
            at = batch.schema.names.index("open")
            still = pc.and_(batch.column(at), pa.array(undecided))
            batch = batch.set_column(at, batch.schema.field(at), still)
            yield batch.filter(pa.array(undecided | first.value.maybe(own)))

    return rows.mapInArrow(run, rows.schema)


def _runs(spans: pa.ListArray) -> tuple[list[int], list[int], list[int]]:
    """The maximal runs of each row's spans: where those of a row begin and end, first and last bytes.

    Rows are parted by 2**40, so that one order and one running maximum do for all.
    """
    sizes = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    first, last = (x.to_numpy(zero_copy_only=False) for x in spans.flatten().flatten())
    row = np.repeat(np.arange(len(spans), dtype=np.int64), sizes) << 40
    order = np.argsort(row + first, kind="stable")
    first, reach = (row + first)[order], np.maximum.accumulate((row + last)[order])
    new = np.ones(len(first), dtype=bool)
    new[1:] = first[1:] > reach[:-1]
    at = np.flatnonzero(new)
    begins = np.searchsorted(first[at], np.arange(len(spans) + 1, dtype=np.int64) << 40)
    mask = (1 << 40) - 1
    ends = np.append(at[1:], len(new))[: len(at)] - 1
    return begins.tolist(), (first[at] & mask).tolist(), (reach[ends] & mask).tolist()


def remove_repeats(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    gram: int = GRAM,
    group: int = GROUP,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay) and kept_sha256.

    ``kept`` is null where nothing was removed, so that unchanged texts are not moved.
    """
    spark = documents.sparkSession
    stage = Stage(spark, "repeats")
    rows = documents.select(F.col(doc_id).alias("doc_id"), text_column(documents, text).alias("text"))
    rows = rows.withColumn("t", F.xxhash64("text", F.octet_length("text")))
    copies = rows.groupBy("t").agg(F.count("*").alias("n"), F.min(F.octet_length("text")).alias("b"))
    copies = stage.table("copies", copies.where(f"n > 1 and b >= {width}").select("t"))
    texts = rows.where(F.octet_length("text") >= width).select("t", "text")
    if width > SIDE:
        raise ValueError(f"width is at most {SIDE}")
    spans = repeated_spans(texts, stage, width, gram, group)
    spans = stage.table("spans", spans.join(copies, "t", "left_anti"))
    stage.drop("anchors", "reach")
    changed = spark.sparkContext.broadcast(key_filter(spans, "t"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts that may change go on as they are, of the others only size and hash."""
        for batch in batches:
            if not batch.num_rows:
                continue
            move = changed.value.maybe(batch.column(2).to_numpy(zero_copy_only=False))
            raw = [x.as_buffer().to_pybytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(x) for x in raw], pa.int64()),
                    pa.array([x if m else None for x, m in zip(raw, move)], pa.binary()),
                    pa.array([None if m else hashlib.sha256(x).hexdigest() for x, m in zip(raw, move)], pa.string()),
                ],
                names=["doc_id", "t", "n_bytes", "bytes", "sha"],
            )

    slim = rows.mapInArrow(light, f"doc_id {kind}, t long, n_bytes long, bytes binary, sha string")
    # Texts that may change are merged with their spans, as they are for any input of some size:
    # were the spans sent to all tasks while they are few, what is shuffled would seem to grow faster
    # than the input.
    joined = slim.join(spans.hint("merge"), "t", "left").join(
        copies.withColumn("all", F.lit(True)), "t", "left"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, sizes, raws, shas, spans_, alls = batch.columns
            begins, firsts, lasts = _runs(spans_)
            out = []
            for i, (size, raw, sha, everything) in enumerate(
                zip(sizes.to_pylist(), raws, shas.to_pylist(), alls.to_pylist())
            ):
                runs = range(begins[i], begins[i + 1])
                if everything:
                    out.append((size, 1, b"", hashlib.sha256(b"").hexdigest()))
                elif not runs:
                    digest = sha or hashlib.sha256(raw.as_buffer().to_pybytes()).hexdigest()
                    out.append((0, 0, None, digest))
                else:
                    own = raw.as_buffer().to_pybytes()
                    bounds = zip([0, *(lasts[k] for k in runs)], [*(firsts[k] for k in runs), size])
                    kept = b"".join([own[a:b] for a, b in bounds])
                    out.append((size - len(kept), len(runs), kept, hashlib.sha256(kept).hexdigest()))
            removed, n_spans, kept, digests = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    ids, sizes, pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                    pa.array(kept, pa.binary()), pa.array(digests, pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    return joined.select("doc_id", "n_bytes", "bytes", "sha", "spans", "all").mapInArrow(
        cut,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string",
    )
