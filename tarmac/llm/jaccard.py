"""Near-duplicate classes by a grouped prefix join on word shingles.

A text's set holds its distinct shingles of ``WORDS`` words (a shorter text is one shingle). Two
texts link when the Jaccard similarity of their sets reaches ``percent``; classes are the
connected components of the links.

1. Equal sets become one node. Frequent shingles are found by counting those that repeat within
   a batch; the most frequent ones, at most ``heavy``, are put last in the order of all
   shingles, rarest first, the others being ordered by hash. Any order is right; this one keeps
   the shingles of common passages out of the prefixes.
2. A linked pair shares a shingle within both prefixes of ``n - ceil(p n) + 1`` shingles. Nodes
   with the same prefix and size form one group, and only groups enter the index. Shingles of a
   single node are dropped early: a bitmap of fixed size keeps most of them out of the shuffle.
3. Group pairs that share a shingle must pass the size and the position filter; then they are
   expanded to members, and members of a group are compared too. A member's sketch holds the parity of its shingles per bucket, in two to
   four bits a shingle; buckets that differ bound the difference of two sets from below, so most
   pairs that are not similar fall out exactly. The others' whole sets are compared.

Only classes are wanted, so pairs need not all be tried. First, each list of the index is compared
with one pivot, which takes as many pairs as the list is long; links found merge classes. Then
only pairs of a list in different classes remain, and all of those are compared, so no link
between classes is lost. No list is collected, and no list of a single class is paired.

Shingles and sets are compared by 64-bit hashes of their words. Words are separated by ASCII
blanks, A-Z lower-cased. Null and empty text has an empty set, which links with nothing. Repeated
rows each get their row. Rows with a null id keep their set size and have a null class. Only the
named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import wordhash
from tarmac.llm.components import components
from tarmac.llm.shared import Stage, key_filter, text_column, worker_table

WORDS = 5
PERCENT = 80
#: Shingles that are put last in the order: the bound of what is broadcast for it.
HEAVY = 1 << 17
#: Rounds in which lists are compared with a pivot before the rest is paired.
PIVOT_ROUNDS = 2
#: Sets that a task remembers to have sent; it forgets them all when there are more.
SENT = 200_000
#: Shingles counted together, and texts worked on together, in a task.
COUNTED, ROWS = 2_000_000, 1_000


def shingle_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, data, offsets in wordhash.text_slices(column):
        found = wordhash.Words(data, offsets, wordhash.BLANK_SEPARATED)
        hashes = found.hashes()
        runs = wordhash.sequence_hashes(hashes, words)
        first = found.first.tolist()
        for a, b in zip(first, first[1:]):
            if b - a >= words:
                s = np.sort(runs[a : b - words + 1])
                yield s if len(s) == 1 else s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                yield wordhash.sequence_hashes(hashes[a:b], b - a)
            else:
                yield hashes[:0]


def signature(shingles: np.ndarray) -> int:
    """A hash of a set, or of a sequence, of shingles with its size."""
    order = wordhash.powers(0xD1B54A32D192ED03, len(shingles) + 1)
    with np.errstate(over="ignore"):
        total = (wordhash.mix(shingles.copy()) * order[1:]).sum(dtype=np.uint64)
    return int(wordhash.mix(np.array([total + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def sketch(shingles: np.ndarray) -> bytes:
    """For each bucket of shingles, whether their number is odd; at least two buckets a shingle."""
    buckets = max(256, 1 << (2 * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the shingles that only one of two sets has, from their sketches."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    size = min(len(a), len(b)) * 8
    # Buckets are low bits, so halves of a larger sketch fold into those of a smaller.
    both = x ^ y
    low = (1 << size) - 1
    folded = 0
    while both:
        folded ^= both & low
        both >>= size
    return folded.bit_count()


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


class Order:
    """The order of shingles: by hash, then the heavy ones by rank."""

    def __init__(self, heavy: np.ndarray):
        """``heavy`` in order, the rarest first."""
        by_hash = np.argsort(heavy)
        self.known, self.rank = heavy[by_hash], by_hash.astype(np.uint64)

    def prefix(self, shingles: np.ndarray, percent: int) -> np.ndarray:
        """The first shingles of a sorted set in this order."""
        size = prefix_size(len(shingles), percent)
        if not len(self.known):
            return shingles[:size]
        place = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        is_heavy = self.known[place] == shingles
        light = shingles[~is_heavy]
        if len(light) >= size:
            return light[:size]
        last = shingles[is_heavy][np.argsort(self.rank[place[is_heavy]])]
        return np.concatenate([light, last[: size - len(light)]])


def _longs(x) -> pa.Array:
    return pa.array(np.asarray(x, dtype=np.uint64).view(np.int64))


class _Pass:
    """The passes over the texts; each reads (id, text) and hands on arrays."""

    def __init__(self, documents: DataFrame, doc_id: str, text: str, words: int, percent: int):
        self.rows = documents.select(
            F.col(doc_id).cast("long").alias("id"),
            text_column(documents, text).alias("text"),
            F.xxhash64(text_column(documents, text)).alias("t"),
        )
        self.words, self.percent = words, percent
        self.parallelism = documents.sparkSession.sparkContext.defaultParallelism

    def sets_and_counts(self) -> DataFrame:
        """kind 0: id, set size, signature, text hash; kind 1: a shingle h and its count n in a batch."""
        words = self.words

        def counted(waiting: list[np.ndarray]) -> pa.RecordBatch:
            s, n = np.unique(np.concatenate(waiting), return_counts=True)
            s, n = s[n > 1], n[n > 1]
            return _batch(np.ones(len(s)), _longs(s), n, _longs(s), _longs(s))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            worker_table("jaccard")
            waiting: list[np.ndarray] = []
            size = 0
            for batch in batches:
                n, h = [], []
                for s in shingle_sets(batch.column(1), words):
                    n.append(len(s))
                    h.append(signature(s) if len(s) else 0)
                    waiting.append(s)
                    size += len(s)
                    if size > COUNTED:
                        yield counted(waiting)
                        waiting, size = [], 0
                yield _batch(np.zeros(len(n)), batch.column(0), n, h, batch.column(2))
            if waiting:
                yield counted(waiting)

        # Few tasks count more together: a shingle that repeats is found with fewer copies.
        rows = self.rows.coalesce(max(self.parallelism, self.rows.rdd.getNumPartitions() // 8))
        return rows.mapInArrow(run, "kind int, id long, n long, h long, t long")

    def postings(self, order, known=None) -> DataFrame:
        """kind 0: node h, group g, size n, sketch; kind 1: shingle h, group g, size n, position at.

        Without ``known``, (h, node) of all shingles; else shingles that may be known, and their nodes.
        """
        words, percent = self.words, self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    yield from post(batch.column(1).slice(at, ROWS))

        def post(texts: pa.Array) -> Iterator[pa.RecordBatch]:
            prefixes, sizes, groups, nodes, sketches = [], [], [], [], []
            seen = set()
            for s in shingle_sets(texts, words):
                if not len(s):
                    continue
                node = signature(s)
                if node in seen:  # copies close by
                    continue
                seen.add(node)
                p = order.value.prefix(s, percent)
                group = signature(np.append(p, np.uint64(len(s))))
                if known is not None:
                    kept = known.value.maybe(p.view(np.int64))
                    if not kept.any():
                        continue
                    sketches.append(sketch(s))
                prefixes.append(p)
                sizes.append(len(s))
                groups.append(group)
                nodes.append(node)
            if not nodes:
                return
            lengths = np.array([len(p) for p in prefixes])
            flat = np.concatenate(prefixes).view(np.int64)
            of = np.repeat(np.arange(len(nodes)), lengths)
            g, n = np.array(groups, np.int64), np.array(sizes, np.int64)
            if known is None:
                of_node = np.array(nodes, np.int64)[of]
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(of_node)], names=["h", "node"])
                return
            at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            kept = known.value.maybe(flat)
            flat, at, of = flat[kept], at[kept], of[kept]
            yield _batch(np.zeros(len(nodes)), nodes, g, n, n, pa.array(sketches, pa.binary()), names=_POSTED)
            nothing = pa.nulls(len(flat), pa.binary())
            yield _batch(np.ones(len(flat)), flat, g[of], n[of], at, nothing, names=_POSTED)

        if known is None:
            return self.rows.mapInArrow(run, "h long, node long")
        return self.rows.mapInArrow(run, "kind int, h long, g long, n long, at long, sketch binary")

    def sets(self, wanted) -> DataFrame:
        """node, and its shingles as bytes, of rows whose id and node may be wanted."""
        words = self.words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sent: set[int] = set()
            for batch in batches:
                if len(sent) > SENT:
                    sent.clear()
                ids = batch.column(0).fill_null(0).to_numpy()
                for at in range(0, batch.num_rows, ROWS):
                    kept: dict[int, bytes] = {}
                    for i, s in enumerate(shingle_sets(batch.column(1).slice(at, ROWS), words), at):
                        if len(s):
                            node = signature(s)
                            key = np.array([node ^ int(ids[i])], dtype=np.int64)
                            if node not in sent and wanted.value.maybe(key)[0]:
                                sent.add(node)
                                kept[node] = s.tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(kept), pa.int64()), pa.array(list(kept.values()), pa.binary())],
                        names=["node", "shingles"],
                    )

        return self.rows.mapInArrow(run, "node long, shingles binary")


_COUNTED, _POSTED = ("kind", "id", "n", "h", "t"), ("kind", "h", "g", "n", "at", "sketch")


def _batch(*columns, names: tuple[str, ...] = _COUNTED) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(columns[0]).astype(np.int32))]
    for c in columns[1:]:
        arrays.append(c if isinstance(c, pa.Array) else pa.array(np.asarray(c, dtype=np.int64)))
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    heavy: int = HEAVY,
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id of its class), text_hash and class.

    ``class`` numbers the classes, also those that share a smallest id; texts without words have none.
    """
    spark = documents.sparkSession
    stage = Stage(spark, "jaccard")
    reader = _Pass(documents, doc_id, text, words, percent)
    first = stage.table("sets", reader.sets_and_counts())
    docs = first.where("kind = 0").select("id", F.col("n").alias("n_shingles"), F.col("h").alias("node"), "t")
    # Of several rows of a node, the smallest id stands for it.
    nodes = docs.where("n_shingles > 0").groupBy("node").agg(F.min("id").alias("id"))
    nodes = stage.table("nodes", nodes)

    counts = first.where("kind = 1").groupBy("h").agg(F.sum("n").alias("n")).where("n > 2")
    top = counts.orderBy(F.desc("n"), "h").limit(heavy).collect()
    ranked = np.array([r.h for r in reversed(top)], dtype=np.int64).view(np.uint64)
    order = spark.sparkContext.broadcast(Order(ranked))

    every = reader.postings(order)
    shared = every.groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = stage.table("shared", shared.where("lo < hi").select("h"))
    known = spark.sparkContext.broadcast(key_filter(shared, "h"))
    second = stage.table("postings", reader.postings(order, known))
    # Workers hold what was broadcast until it is ended.
    for used in (known, order):
        used.destroy()
    members = second.where("kind = 0").select(F.col("h").alias("node"), "g", "n", "sketch")
    members = stage.table("members", members.dropDuplicates(["node"]).join(nodes, "node"))
    lists = (
        second.where("kind = 1")
        .groupBy("h", "g")
        .agg(F.min("n").alias("n"), F.min("at").alias("at"))
        .join(shared, "h")
    )
    lists = stage.table("lists", lists)
    stage.drop("shared", "postings")

    links = tested = roots = None
    for round_ in range(PIVOT_ROUNDS + 1):
        with_class = _classes(members, roots, stage, round_)
        if round_ < PIVOT_ROUNDS:
            groups = with_class.groupBy("g").agg(
                F.min(F.struct("id", "node")).alias("leader"),
                F.min("root").alias("lo"),
                F.max("root").alias("hi"),
                F.count("*").alias("members"),
            )
            groups = stage.table(f"groups-{round_}", groups)
            pairs = _pivot_pairs(lists, groups, with_class, percent, round_)
        else:
            pairs = _rest(lists, with_class, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage.table(f"pairs-{round_}", pairs)
        tested = pairs if tested is None else tested.unionByName(pairs)
        likely = stage.table(f"likely-{round_}", _likely(pairs, members, percent))
        if not likely.take(1):
            continue
        found = _verified(likely, nodes, reader, percent, stage, round_)
        links = found if links is None else links.unionByName(found)
        roots = stage.table(f"roots-{round_}", components(links, stage, f"components-{round_}"))

    final = _classes(nodes, roots, stage, "final")
    lowest = final.groupBy("root").agg(F.min("id").alias("component_id"))
    by_node = final.join(lowest, "root").select("node", "root", "component_id")
    alone = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return docs.join(by_node, "node", "left").select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.when(F.col("id").isNotNull(), alone).alias("component_id"),
        F.col("t").alias("text_hash"),
        F.col("root").alias("class"),
    )


def keep_one(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """One row of each class, that of its smallest id, with all columns.

    Of several texts of that id the one with the smallest hash stays. Texts without words are no
    copies of each other, and rows with a null id all stay. Most texts stay where they are: only
    rows that a bitmap of fixed size names are joined with the rows to go, which are known by id
    and text hash.
    """
    stage = Stage(documents.sparkSession, "classes")
    found = near_duplicates(documents, doc_id, text, **options).where("doc_id is not null")
    found = stage.table("found", found.select("doc_id", "text_hash", "class"))
    own = F.struct("doc_id", "text_hash")
    several = found.where("class is not null").groupBy("class").agg(
        F.min(own).alias("kept"), F.max(own).alias("last")
    )
    several = several.where("kept <> last").select("class", "kept")
    gone = found.join(several, "class").where(own != F.col("kept"))
    gone = gone.select("doc_id", "text_hash").distinct()
    again = found.groupBy("doc_id", "text_hash").count().where("count > 1")
    gone = stage.table("gone", gone)
    key = F.xxhash64("doc_id", "text_hash").alias("key")
    touched = gone.select(key).union(again.select(key))
    bits = documents.sparkSession.sparkContext.broadcast(key_filter(touched, "key"))

    @F.pandas_udf("boolean")
    def maybe(keys: pd.Series) -> pd.Series:
        return pd.Series(bits.value.maybe(keys.to_numpy(dtype=np.int64)))

    hashed = documents.withColumn("__t", F.xxhash64(text_column(documents, text)))
    hashed = hashed.withColumn("__id", F.col(doc_id).cast("long"))
    hashed = hashed.withColumn("__maybe", maybe(F.xxhash64("__id", "__t")))
    rest = hashed.where("__maybe and __id is not null").join(
        gone.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__t")),
        ["__id", "__t"],
        "left_anti",
    )
    rest = rest.dropDuplicates(["__id", "__t"])
    kept = hashed.where("not __maybe or __id is null")
    return kept.select(*documents.columns).unionByName(rest.select(*documents.columns))


def _classes(members: DataFrame, roots: DataFrame | None, stage: Stage, round_) -> DataFrame:
    """Members, or nodes, with the root of their class."""
    if roots is None:
        return members.withColumn("root", F.col("node"))
    joined = members.join(roots, "node", "left")
    return stage.table(f"classes-{round_}", joined.withColumn("root", F.coalesce("root", "node")))


def _size_filter(percent: int, a: str = "n", b: str = "n2") -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _position_filter(percent: int) -> str:
    """What follows the first shared shingle, at ``at`` and ``at2``, with it, must be enough.

    A linked pair has a row for its first shared shingle, which passes; rows for later ones, which
    disregard what was shared before, may fail, and so most rows of long lists do.
    """
    return f"least(n - at, n2 - at2) * {100 + percent} >= {percent} * (n + n2)"


def _pivot_pairs(lists, groups, members, percent: int, round_: int) -> DataFrame:
    """Node pairs of each list's pivot group and its other groups of another class."""
    own = lists.join(groups, "g")
    salt = F.lit(0) if round_ == 0 else F.xxhash64("g", F.lit(round_))
    pivot = own.groupBy("h").agg(
        F.min(F.struct(salt.alias("salt"), F.col("leader.id").alias("id"), "g", "n", "at", "lo", "hi", "leader")).alias("p"),
        F.min("lo").alias("all_lo"),
        F.max("hi").alias("all_hi"),
    )
    pivot = pivot.where("all_lo < all_hi").select(
        "h",
        F.col("p.g").alias("g2"),
        F.col("p.n").alias("n2"),
        F.col("p.at").alias("at2"),
        F.col("p.lo").alias("lo2"),
        F.col("p.hi").alias("hi2"),
        F.col("p.leader.node").alias("pivot"),
    )
    pairs = (
        own.select("h", "g", "n", "at", "lo", "hi", "members")
        .join(pivot, "h")
        .where("g <> g2 and not (lo = hi and lo2 = hi2 and lo = lo2)")
        .where(_size_filter(percent))
        .where(_position_filter(percent))
        .select("g", F.col("pivot").alias("a"))
        .distinct()
    )
    # Within a group, members are compared with its leader.
    inside = groups.where("members > 1 and lo < hi").select("g", F.col("leader.node").alias("a"))
    return _apart(pairs.union(inside).join(members, "g"), members)


def _apart(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b) of distinct nodes in different classes, from rows with a, node and root."""
    other = members.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    found = pairs.select("a", F.col("node").alias("b"), "root").join(other, "a")
    found = found.where("a <> b and root <> root_a")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rest(lists, members, percent: int) -> DataFrame:
    """All node pairs of groups that share a shingle, pass the filters, and are in different classes.

    Pairs of groups are filtered, each once however many shingles they share, and then expanded.
    """
    groups = members.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    rows = lists.join(groups, "g")
    mixed = rows.groupBy("h").agg(F.min("lo").alias("least"), F.max("hi").alias("most"))
    rows = rows.join(mixed.where("least < most").select("h"), "h")
    rows = rows.select("h", "g", "n", "at", "lo", "hi")
    other = rows.toDF("h", "g2", "n2", "at2", "lo2", "hi2")
    each = rows.join(other, "h").where("g < g2 and not (lo = hi and lo2 = hi2 and lo = lo2)")
    each = each.where(_size_filter(percent)).where(_position_filter(percent))
    inside = groups.where("lo < hi").select("g", F.col("g").alias("g2"))
    pairs = each.select("g", "g2").distinct().unionByName(inside)
    own = members.select("g", "node", "root")
    both = pairs.join(own, "g").join(own.toDF("g2", "node2", "root2"), "g2").where("root <> root2")
    return both.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def _likely(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches do not rule them out."""
    own = members.select("node", "n", "sketch")
    joined = (
        pairs.join(own.toDF("b", "n", "x"), "b").join(own.toDF("a", "n2", "y"), "a")
    ).select("a", "b", "n", "n2", "x", "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            sketches = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            # Of n + n2 shingles a share of (1 - s) / (1 + s) at most may differ.
            kept = [
                (100 + percent) * least_difference(x, y) <= (100 - percent) * (n + n2)
                for (n, n2), (x, y) in zip(sizes, sketches)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]
            ).filter(pa.array(kept, pa.bool_()))

    return joined.mapInArrow(compare, "a long, b long")


def _verified(pairs, nodes, reader: _Pass, percent: int, stage: Stage, round_: int) -> DataFrame:
    """The pairs whose whole sets are similar enough; a set may come from several tasks."""
    spark = pairs.sparkSession
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node")
    # A text whose rows have no id is known by its set alone.
    bits = key_filter(wanted.select(F.expr("node ^ coalesce(id, 0)").alias("key")), "key")
    shared = spark.sparkContext.broadcast(bits)
    sets = reader.sets(shared).withColumnRenamed("shingles", "s")
    sets = stage.table(f"shingles-{round_}", sets)
    shared.destroy()
    joined = (
        pairs.join(sets.select(F.col("node").alias("b"), F.col("s").alias("s")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("s").alias("s2")), "a")
        .select("a", "b", "s", "s2")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (s, t) if len(s) < len(t) else (t, s)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                kept.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]
            ).filter(pa.array(kept))

    linked = joined.mapInArrow(compare, "a long, b long").distinct()
    found = stage.table(f"links-{round_}", linked)
    stage.drop(f"shingles-{round_}")
    return found
