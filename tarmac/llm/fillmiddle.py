"""Fill-in-the-middle: texts cut at two unit boundaries and put in another order.

A unit is a word with the blanks before it, or the blanks that end a text. A boundary lies at each
blank that follows a non-blank; so units need not be listed. A wavelet matrix over the classes of
a slice of texts, one symbol per byte, gives the rank of any class at any place: the ranks of the two
classes of boundaries add up to the units begun before a place, places less the rank of
continuation bytes are code points, and a cut at the k-th boundary is found by bisection on ranks,
for all texts of the slice at once.

The two cuts and the form are drawn from the hash of seed and id, so a repeated task, another
partitioning or a rerun gives the same rows. The form is ``plain`` (the text as it is) for empty
texts, for texts that contain a mark, and for the share that ``rate`` leaves out; else ``spm`` or
``psm`` by ``spm_rate``, in percent.

There is no shuffle. Null text counts as empty; a null id is hashed as empty text; repeated rows
give equal rows each; an empty table gives none. Only the named columns are read, and kept columns
may have any name but those added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import wordhash
from tarmac.llm.shared import text_column

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Classes of bytes. Blanks are space, tab and the line breaks; each stands after a non-blank and
#: so begins a unit, or not.
CONTINUATION, LETTER, SPACE, BREAK, SPACE_BEGINS, BREAK_BEGINS = range(6)
_LEVELS = 3

_CLASS = np.full(256, LETTER, dtype=np.uint8)
_CLASS[0x80:0xC0] = CONTINUATION
_CLASS[[0x20, 0x09]] = SPACE
_CLASS[0x0A:0x0E] = BREAK


class RankedBits:
    """Bits with the number of ones before any place, from counts per 64 bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype="<u8")
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        low = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Symbols, one level of bits per bit of theirs, zeros before ones from level to level."""

    def __init__(self, symbols: np.ndarray, levels: int = _LEVELS):
        self.levels: list[tuple[int, RankedBits, int]] = []
        for shift in range(levels - 1, -1, -1):
            ones = (symbols >> shift) & 1 == 1
            zeros = symbols[~ones]
            self.levels.append((shift, RankedBits(ones), len(zeros)))
            symbols = np.concatenate([zeros, symbols[ones]])

    def rank(self, symbol: int, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each place."""
        first, last = np.zeros(1, dtype=np.int64), place.astype(np.int64)
        for shift, bits, zeros in self.levels:
            ones = bits.rank(np.concatenate([first, last]))
            if symbol >> shift & 1:
                first, last = zeros + ones[:1], zeros + ones[1:]
            else:
                first, last = first - ones[:1], last - ones[1:]
        return last - first


class Units:
    """Units of the texts of a slice: how many there are, and where the k-th of a text ends."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        symbols = _CLASS[data]
        blank = symbols >= SPACE
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[heads] = False
        symbols[begins] += SPACE_BEGINS - SPACE
        self.matrix = WaveletMatrix(symbols)
        self.offsets = offsets
        self.begun = self._boundaries(offsets)
        self.count = np.diff(self.begun) + (offsets[1:] > offsets[:-1])

    def _boundaries(self, place: np.ndarray) -> np.ndarray:
        return self.matrix.rank(SPACE_BEGINS, place) + self.matrix.rank(BREAK_BEGINS, place)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The place behind the first ``units`` of each text, which may be none or all."""
        low, high = self.offsets[:-1].copy(), self.offsets[1:].copy()
        wanted = self.begun[:-1] + units
        # The first place at which the wanted number of units has begun, less the byte there.
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            # A text that is done, at the end of the slice, has no place behind it.
            reached = self._boundaries(np.minimum(middle + 1, high)) >= wanted
            high = np.where(open_ & reached, middle, high)
            low = np.where(open_ & ~reached, middle + 1, low)
        low = np.where(units >= self.count, self.offsets[1:], low)
        return np.where(units <= 0, self.offsets[:-1], low)

    def chars(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Code points from place to place."""
        rank = self.matrix.rank(CONTINUATION, np.concatenate([first, last]))
        return last - first - (rank[len(first) :] - rank[: len(first)])


def hashed(seed: int, key: Column, group: int) -> Column:
    """The ``group``-th 8 hexadecimal digits, from 1, of the sha256 of seed and key, as a number."""
    whole = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.substring(F.sha2(whole.cast("binary"), 256), 8 * group - 7, 8)
    return F.conv(digits, 16, 10).cast("long")


def cut(documents: DataFrame, keep: list[str], key: str, text: str, seed: int) -> DataFrame:
    """``keep`` columns with n (units), prefix, middle, suffix and the code points of the first two."""
    rows = documents.select(
        *keep,
        hashed(seed, F.col(key), 1).alias("__h1"),
        hashed(seed, F.col(key), 2).alias("__h2"),
        text_column(documents, text).alias("__text"),
    )
    schema = rows.drop("__h1", "__h2", "__text").schema
    schema = schema.add("n", "long").add("prefix", "string").add("middle", "string")
    schema = schema.add("suffix", "string").add("prefix_chars", "long").add("middle_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, h1, h2, texts = batch.columns
            h1, h2 = (h.to_numpy(zero_copy_only=False) for h in (h1, h2))
            for row, data, offsets in wordhash.text_slices(texts):
                size = len(offsets) - 1
                units = Units(data, offsets)
                drawn = [h[row : row + size] % (units.count + 1) for h in (h1, h2)]
                first, second = (units.cut(f(*drawn)) for f in (np.minimum, np.maximum))
                bounds = np.stack([offsets[:-1], first, second], axis=1).reshape(-1)
                parts = pa.LargeStringArray.from_buffers(
                    3 * size,
                    pa.py_buffer(np.append(bounds, offsets[-1]).astype(np.int64)),
                    pa.py_buffer(np.ascontiguousarray(data)),
                )
                place = np.arange(0, 3 * size, 3)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(row, size) for c in kept),
                        pa.array(units.count, pa.int64()),
                        *(parts.take(pa.array(place + k)).cast(pa.string()) for k in range(3)),
                        pa.array(units.chars(offsets[:-1], first), pa.int64()),
                        pa.array(units.chars(first, second), pa.int64()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def fill_in_middle(
    documents: DataFrame,
    keep: list[str],
    key: str = "doc_id",
    text: str = "text",
    seed: int = 42,
    rate: int = 50,
    spm_rate: int = 80,
) -> DataFrame:
    """``keep`` columns with n (units), form, output, prefix_chars and middle_chars (null if plain)."""
    marked = documents.select(
        *keep,
        F.struct(
            hashed(seed, F.col(key), 3).alias("h3"), hashed(seed, F.col(key), 4).alias("h4")
        ).alias("__drawn"),
        F.col(key).alias("__key"),
        F.col(text).alias("__whole"),
    )
    parts = cut(marked, [*keep, "__drawn"], "__key", "__whole", seed)
    prefix, middle, suffix = F.col("prefix"), F.col("middle"), F.col("suffix")
    whole = F.concat(prefix, middle, suffix)
    plain = (F.length(whole) == 0) | (F.col("__drawn.h3") % 100 >= rate)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain |= F.contains(whole, F.lit(mark))
    spm = F.col("__drawn.h4") % 100 < spm_rate
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    form = F.when(plain, "plain").when(spm, "spm").otherwise("psm")
    output = (
        F.when(plain, whole)
        .when(spm, F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.concat(p, prefix, s, suffix, m, middle))
    )
    return parts.select(
        *keep,
        "n",
        form.alias("form"),
        output.alias("output"),
        *(F.when(~plain, F.col(c)).alias(c) for c in ("prefix_chars", "middle_chars")),
    )


def restored(form: Column, output: Column) -> Column:
    """The text an output was made of. Marks occur in no cut text, so they part it into three."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)

    def joined(*order: int) -> Column:
        return F.concat(*(F.get(parts, F.lit(i)) for i in order))

    return F.when(form == "psm", joined(1, 3, 2)).when(form == "spm", joined(2, 3, 1)).otherwise(output)
