"""Removal of repeated runs of lines, over a suffix array built by distributed prefix doubling.

A text is the sequence of its non-blank lines; a line's id is the hash of its characters. Rank 0
of a suffix is its first line. In each round the ranks of a suffix and of the one ``2**k`` lines
on are joined, equal pairs form an interval of the suffix array of common prefix ``2**(k + 1)``,
and the sorted pairs number the new ranks. Suffixes whose prefix is unique are sorted and leave;
rounds end when none is left, after about log2 of the longest repeated run.

An interval of common prefix ``min_lines`` or more holds the copies of a run. Its first suffix, in
order of document id and line, is the original, and the lines of all later ones are deleted;
overlapping intervals join to the maximal repeated run. A single line of ``min_words`` words or
more is a run by itself, so long passages are found whatever their neighbours; its interval is
that of rank 0. The first place of a line is never deleted, so no text is lost altogether.

All steps are DataFrame operations. Each interval is a pair of minima and maxima that combine
before the shuffle, and a frequent line or run is the many side of a join that adaptive execution
splits; no interval is collected. Every round's table is written. Rows that repeat an id and a text
enter once, so the tables hold one suffix per line and place, however often a row is repeated.
Texts are not moved, but for those that a bitmap of fixed size says may change.

Null text stays null, text without lines stays as it is. Rows that repeat an id and a text are one
document and answered alike; of rows that share an id with different texts the order is that of
the texts' hashes; a null id precedes all others. Blank lines are kept. Columns other than the
text pass through. Documents and lines are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.shared import Stage

#: Shortest run that counts as repeated, in lines.
MIN_LINES = 2
#: Words, parted by ASCII blanks, with which a single line counts as a run.
MIN_WORDS = 50
#: Bits of the bitmap of documents that may change: 4 MB, whatever their number.
BITMAP_BITS = 25

_WORD = "[^\\x20\\x09-\\x0D]+"


def _document(doc_id: str, text: str) -> Column:
    """A number for each id and text; a null id is one of its own."""
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))), F.xxhash64(text))


def line_positions(
    documents: DataFrame, stage: Stage, doc_id: str, text: str, min_words: int
) -> DataFrame:
    """(d, i, j, at, line, long): document, number among non-blank lines, line number, place, hash.

    ``long`` tells whether the line has at least ``min_words`` words.
    """
    full = F.filter(
        F.transform(F.split(text, "\n"), lambda x, j: F.struct(j.alias("j"), x.alias("x"))),
        lambda s: F.trim(s["x"]) != "",
    )

    def hashed(s: Column) -> Column:
        # So many words take at least so many characters; most lines need not be searched.
        enough = (F.length(s["x"]) >= 2 * min_words - 1) & (
            F.regexp_count(s["x"], F.lit(_WORD)) >= min_words
        )
        return F.struct(s["j"].alias("j"), F.xxhash64(s["x"]).alias("line"), enough.alias("long"))

    rows = documents.where(F.col(text).isNotNull()).select(
        _document(doc_id, text).alias("d"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64(text).alias("t"),
        F.transform(full, hashed).alias("h"),
    )
    again = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d")
    again = stage.table("again", again)
    once = rows.join(again, "d", "left_anti")
    rows = once.unionByName(rows.join(again, "d", "left_semi").dropDuplicates(["d"]))
    # Places are ordered by document id, then by the text's hash, then by line.
    first = F.col("id").cast("decimal(38,0)") * F.lit(10**9).cast("decimal(10,0)") + F.pmod(
        "t", F.lit(10**9)
    ).cast("decimal(10,0)")
    spread = rows.select(
        "d", first.cast("decimal(29,0)").alias("first"), F.posexplode("h").alias("i", "s")
    )
    at = (F.col("first") * F.lit(10**9).cast("decimal(10,0)") + F.col("i")).cast("decimal(38,0)")
    return spread.select("d", "i", "s.j", at.alias("at"), "s.line", "s.long")


def _intervals(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur at several places, with the first place."""
    found = rows.groupBy(*keys).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    return found.where("first < last").drop("last")


def _ahead(ranks: DataFrame, lines: int) -> DataFrame:
    """Suffixes with their own rank and that of the suffix ``lines`` on; both must repeat."""
    other = ranks.select("d", (F.col("i") - lines).alias("i"), F.col("rank").alias("rank2"))
    return ranks.select("d", "i", "at", "rank").join(other, ["d", "i"])


def suffix_ranks(
    positions: DataFrame, stage: Stage, min_lines: int
) -> tuple[DataFrame, DataFrame | None]:
    """Doubles until no prefix repeats; the suffixes that repeat in a line, and in ``min_lines``.

    Both have d, i and ``later``, which tells whether the suffix is not the first of its interval.
    """
    lines = _intervals(positions, "line")
    ranks = positions.join(lines, "line").select(
        "d",
        "i",
        "at",
        F.col("line").alias("rank"),
        (F.col("at") > F.col("first")).alias("later"),
        "long",
    )
    ranks = single = stage.table("ranks-0", ranks)
    depth, level, deep = 1, 0, None
    while ranks.take(1):
        if depth <= min_lines < 2 * depth:
            deep = ranks
            if depth < min_lines:  # two overlapping prefixes make up the wanted length
                pairs = _ahead(ranks, min_lines - depth)
                deep = pairs.join(_intervals(pairs, "rank", "rank2"), ["rank", "rank2"])
                deep = stage.table("deep", deep.withColumn("later", F.expr("at > first")))
        pairs = stage.table(f"pairs-{level}", _ahead(ranks, depth))
        classes = _intervals(pairs, "rank", "rank2").orderBy("rank", "rank2")
        classes = classes.withColumn("new", F.monotonically_increasing_id())
        classes = stage.table(f"classes-{level}", classes)
        ranks = pairs.join(classes, ["rank", "rank2"]).select(
            "d", "i", "at", F.col("new").alias("rank"), (F.col("at") > F.col("first")).alias("later")
        )
        depth, level = 2 * depth, level + 1
        ranks = stage.table(f"ranks-{level}", ranks)
        stage.drop(f"pairs-{level - 1}", f"classes-{level - 1}")
    return single, deep


def _bitmap(keys: DataFrame, key: str) -> Column:
    """Pieces of a bitmap of keys by number, as one value for all rows of a query."""
    place = F.pmod(F.col(key), F.lit(1 << BITMAP_BITS)) + 1
    pieces = keys.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    return pieces.agg(F.map_from_entries(F.collect_list(F.struct("piece", "bits")))).scalar()


def _maybe(bitmap: Column, key: str) -> Column:
    """False if the key is in no piece of the bitmap."""
    place = F.pmod(F.col(key), F.lit(1 << BITMAP_BITS)) + 1
    bit = F.bitmap_bit_position(place).cast("int")
    piece = F.try_element_at(bitmap, F.bitmap_bucket_number(place))
    octet = F.conv(F.hex(F.substring(piece, F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), bit % 8 + 1)
    return F.coalesce(octet.bitwiseAND(mask) != 0, F.lit(False))


def remove_repeated_lines(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_lines: int = MIN_LINES,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The rows with all their columns, the text without later copies of repeated runs.

    Adds n_lines (all lines), n_removed, and longest_run, the lines of the longest run removed;
    columns of these names are replaced.
    """
    stage = Stage(documents.sparkSession, "lines")
    positions = line_positions(documents, stage, doc_id, text, min_words)
    positions = stage.table("positions", positions)
    single, deep = suffix_ranks(positions, stage, min_lines)
    covered = single.where("later and long").select("d", "i")
    if deep is not None:
        runs = F.explode(F.sequence(F.col("i"), F.col("i") + (min_lines - 1)))
        covered = covered.unionByName(deep.where("later").select("d", runs.alias("i")))
    gone = (
        positions.join(covered.distinct(), ["d", "i"])
        .groupBy(F.col("d").alias("__d"))
        .agg(F.array_sort(F.collect_set("j")).alias("__gone"))
    )
    gone = stage.table("gone", gone)
    rows = documents.drop("n_lines", "n_removed", "longest_run")
    rows = rows.withColumn("__d", _document(doc_id, text))
    rows = rows.withColumn("__maybe", _maybe(_bitmap(gone, "__d"), "__d"))
    # Merged at every size, so that what is shuffled keeps in proportion to what changes.
    changed = rows.where("__maybe").join(gone.hint("merge"), "__d", "left")
    lines = F.split(text, "\n")
    # What stays lies between the deleted lines.
    bounds = F.zip_with(
        F.concat(F.array(F.lit(-1)), "__gone"),
        F.concat("__gone", F.array(F.size("__lines"))),
        lambda a, b: F.slice("__lines", a + 2, b - a - 1),
    )
    shorter = F.when(F.size("__gone") > 0, F.array_join(F.flatten(bounds), "\n")).otherwise(F.col(text))
    runs = F.aggregate(
        "__gone",
        F.struct(F.lit(-2).alias("last"), F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda s, j: F.struct(
            j.alias("last"),
            F.when(j == s["last"] + 1, s["now"] + 1).otherwise(1).alias("now"),
            F.greatest(s["most"], F.when(j == s["last"] + 1, s["now"] + 1).otherwise(1)).alias("most"),
        ),
        lambda s: s["most"].cast("long"),
    )
    none = F.expr("cast(array() as array<int>)")
    changed = changed.withColumns({"__gone": F.coalesce("__gone", none), "__lines": lines})
    names = [c for c in rows.columns if c not in ("__d", "__maybe")]
    n_lines = F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines")
    zero = F.lit(0).cast("long")
    same = rows.where("not __maybe").select(
        *names, n_lines, zero.alias("n_removed"), zero.alias("longest_run")
    )
    return same.unionByName(
        changed.select(
            *[F.col(c) if c != text else shorter.alias(text) for c in names],
            n_lines,
            F.size("__gone").cast("long").alias("n_removed"),
            runs.alias("longest_run"),
        )
    )
