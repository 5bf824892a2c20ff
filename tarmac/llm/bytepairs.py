"""Byte-level BPE encoding and decoding, with a segment tree over byte positions.

A text is cut by a pattern; each match is encoded on its own. A match that is a token as a whole is
that token. Else every byte starts as a part, and the pair of live neighbours of the lowest rank,
leftmost if several have it, is merged until no pair has a rank. The tree's leaf at byte p holds
the rank of the pair that begins with the part at p, together with p, so the smallest key of a
node is the leftmost minimum of its bytes. A merge joins two parts and renews three leaves: the
part's own, that of its live neighbour before, and that of the part which ceased to be. Each is a
logarithmic update, so a match of n bytes takes O(n log n) steps, however long it is. Matches of up
to ``SHORT`` bytes are merged many at a time, their trees being the rows of one array; longer ones
one by one.

Matches repeat, so a worker remembers what it encoded, up to ``REMEMBERED_BYTES`` and a slice.
There is no shuffle: every batch is encoded where it is read, in slices of texts of at most
``SLICE_CHARS`` or of one longer text, so a task holds one input batch and one slice.

Null text counts as empty and has no ids; repeated rows and null ids of rows give a row each; an
empty table gives none. Decoding gives null for a null list and for one that holds null or an id
without token. Only the named columns are read, and kept columns may have any name but those added.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tarmac.llm.shared import text_column, worker_table

#: Characters of texts that are encoded, and leave, together; longer texts are listed in parts.
SLICE_CHARS = 1 << 20
#: Lists that are decoded, and leave, together.
DECODED_ROWS = 256
#: Size of the table of encoded matches, at which it starts anew: its entries, estimated.
REMEMBERED_BYTES = 64 << 20
_ENTRY_BYTES = 180
#: Matches of up to so many bytes are merged many at a time.
SHORT = 64
#: Stands for the rank of a pair that has none.
_NONE = 1 << 40


def merged_parts(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of the parts of one match after all merges."""
    n = len(piece)
    if piece in ranks or not n:
        return [ranks[piece]] if n else []
    rank_of = ranks.get
    shift = n.bit_length()
    mask, none = (1 << shift) - 1, _NONE << shift
    # A key is rank, then place, of the pair that begins at a byte; least[1] is the whole tree's.
    size = 1 << (n - 1).bit_length()
    level = [rank_of(piece[p : p + 2], _NONE) << shift | p for p in range(n - 1)]
    level += [none] * (size - n + 1)
    least = level
    while len(level) > 1:
        level = list(map(min, level[::2], level[1::2]))
        least = level + least
    least = [none, *least]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    while (root := least[1]) < none:
        place = root & mask
        gone = after[place]
        end = after[place] = after[gone]
        renewed = [(gone, none)]
        if end < n:
            before[end] = place
            rank = rank_of(piece[place : after[end]], _NONE)
            renewed.append((place, rank << shift | place))
        else:
            renewed.append((place, none))
        first = before[place]
        if first >= 0:
            renewed.append((first, rank_of(piece[first:end], _NONE) << shift | first))
        for leaf, key in renewed:
            node = leaf + size
            least[node] = key
            while node > 1:
                other = least[node ^ 1]
                if other < key:
                    key = other
                node >>= 1
                if least[node] == key:
                    break
                least[node] = key
    ids, place = [], 0
    while place < n:
        ids.append(ranks[piece[place : after[place]]])
        place = after[place]
    return ids


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with a token in base 64 and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PairRanks:
    """The rank of the token that two tokens make, for arrays of pairs: an open hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {
            (ranks[token[:cut]], ranks[token[cut:]]): rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        keys = np.fromiter((a << 32 | b for a, b in pairs), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, _NONE, dtype=np.int64)
        place = self._place(keys)
        while len(keys):
            # Of the keys that want a free slot one gets it; the others try the next.
            free = self.keys[place] == -1
            self.keys[place[free]] = keys[free]
            own = self.keys[place] == keys
            self.values[place[own]] = values[own]
            keys, values = keys[~own], values[~own]
            place = (place[~own] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys = first << 32 | second
        place = self._place(keys)
        found = self.values[place]
        other = np.flatnonzero(self.keys[place] != keys)
        while len(other):
            held = self.keys[place[other]]
            settled = (held == keys[other]) | (held == -1)
            found[other[settled]] = self.values[place[other[settled]]]
            other = other[~settled]
            place[other] = (place[other] + 1) & ((1 << self.bits) - 1)
        return found


def merged_together(
    pieces: list[bytes], byte_ids: np.ndarray, rank_of: PairRanks
) -> tuple[np.ndarray, np.ndarray]:
    """``merged_parts`` of many short matches that are no tokens: all ids in a row, and how many each.

    Row r of each table belongs to match r: the keys of its tree, the ids of its parts at the bytes
    they begin with, and the live neighbours. In a step every match merges its own least pair.
    """
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    size = 1 << int(lengths.max() - 1).bit_length()
    shift = size.bit_length()
    mask, none = (1 << shift) - 1, _NONE << shift
    at = np.arange(size)
    inside = at < lengths[:, None]
    ids = np.zeros((len(pieces), size), dtype=np.int64)
    ids[inside] = byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    tree = np.full((len(pieces), 2 * size), none, dtype=np.int64)
    rows, first = np.nonzero(inside[:, 1:])
    tree[rows, size + first] = rank_of(ids[rows, first], ids[rows, first + 1]) << shift | first
    width = size
    while width > 1:
        half = width >> 1
        np.minimum(tree[:, width : 2 * width : 2], tree[:, width + 1 : 2 * width : 2], out=tree[:, half:width])
        width = half
    # One place more, for what lies behind the last part.
    after = np.broadcast_to(np.arange(1, size + 2), (len(pieces), size + 1)).copy().reshape(-1)
    before = np.broadcast_to(np.arange(-1, size), (len(pieces), size + 1)).copy().reshape(-1)
    ids, tree = ids.reshape(-1), tree.reshape(-1)
    live = np.arange(len(pieces))
    while len(live):
        root = tree[live * (2 * size) + 1]
        unfinished = root < none
        live, root = live[unfinished], root[unfinished]
        line, own, ends = live * size, live * (size + 1), lengths[live]
        place = root & mask
        gone = after[own + place]
        end = after[own + gone]
        after[own + place] = end
        before[own + end] = place
        ids[line + place] = root >> shift
        key = np.full(len(live), none)
        some = np.flatnonzero(end < ends)
        key[some] = rank_of(ids[line[some] + place[some]], ids[line[some] + end[some]]) << shift
        key[some] |= place[some]
        previous = before[own + place]
        some = np.flatnonzero(previous >= 0)
        earlier = previous[some]
        earlier_key = rank_of(ids[line[some] + earlier], ids[line[some] + place[some]]) << shift
        base = live * (2 * size) + size
        tree[base + gone] = none
        tree[base + place] = key
        tree[base[some] + earlier] = earlier_key | earlier
        for row, leaf in ((live, gone), (live, place), (live[some], earlier)):
            row, node = row * (2 * size), leaf + size
            for _ in range(shift - 1):
                node = node >> 1
                tree[row + node] = np.minimum(tree[row + 2 * node], tree[row + 2 * node + 1])
    # Live parts are those reached from the first.
    parts = np.zeros((len(pieces), size), dtype=bool)
    live, place = np.arange(len(pieces)), np.zeros(len(pieces), dtype=np.int64)
    while len(live):
        parts[live, place] = True
        place = after[live * (size + 1) + place]
        unfinished = place < lengths[live]
        live, place = live[unfinished], place[unfinished]
    return ids.reshape(parts.shape)[parts], parts.sum(axis=1)


class Encoded(dict):
    """Match to its row: ``flat[bounds[row] : bounds[row + 1]]`` are its ids."""

    def __init__(self) -> None:
        super().__init__()
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.bounds = np.zeros(1 << 14, dtype=np.int64)
        self.chars = 0

    def add(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first, used = len(self), int(self.bounds[len(self)])
        last = first + len(pieces)
        self.flat = _with_room(self.flat, used + len(ids))
        self.bounds = _with_room(self.bounds, last + 1)
        self.flat[used : used + len(ids)] = ids
        np.cumsum(counts, out=self.bounds[first + 1 : last + 1])
        self.bounds[first + 1 : last + 1] += used
        self.update(zip(pieces, range(first, last)))
        self.chars += sum(map(len, pieces))

    def bytes(self) -> int:
        """What the table takes, estimated."""
        return _ENTRY_BYTES * len(self) + 2 * self.chars + 4 * int(self.bounds[len(self)])

    def empty(self) -> None:
        self.clear()
        self.chars = 0

    def ids(self, pieces: Iterable[str], count: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``count`` known matches in a row, and where each match's end."""
        rows = np.fromiter(map(self.__getitem__, pieces), np.int64, count)
        begin = self.bounds[rows]
        size = self.bounds[rows + 1] - begin
        ends = np.cumsum(size)
        total = int(ends[-1]) if count else 0
        return self.flat[np.arange(total) + np.repeat(begin - ends + size, size)], ends


def _with_room(table: np.ndarray, size: int) -> np.ndarray:
    """The table, or a copy of at least twice its length, so that ``size`` entries fit."""
    if size <= len(table):
        return table
    larger = np.zeros(max(size, 2 * len(table)), dtype=table.dtype)
    larger[: len(table)] = table
    return larger


class Codec:
    """Texts to ids and back, by the ranks of a file and a pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = read_ranks(path)
        size = np.zeros(max(self.ranks.values()) + 1, dtype=np.int64)
        for token, rank in self.ranks.items():
            size[rank] = len(token)
        #: The bytes of all tokens by rank, and where each begins.
        self.token_bounds = np.concatenate([[0], np.cumsum(size)])
        joined = b"".join(sorted(self.ranks, key=self.ranks.__getitem__))
        self.token_bytes = np.frombuffer(joined, dtype=np.uint8)
        self.pattern = regex.compile(pattern)
        self.pair_ranks = PairRanks(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.encoded = Encoded()

    def _learn(self, pieces: set[str]) -> None:
        """Encode the matches not yet known: tokens, long ones, and the rest by classes of length."""
        new = list(pieces - self.encoded.keys())
        raw = [piece.encode() for piece in new]
        own = np.fromiter((self.ranks.get(r, -1) for r in raw), np.int64, len(raw))
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        tokens = np.flatnonzero(own >= 0)
        self.encoded.add([new[i] for i in tokens], own[tokens], np.ones(len(tokens), np.int64))
        for i in np.flatnonzero((own < 0) & (size > SHORT)):
            ids = np.array(merged_parts(raw[i], self.ranks))
            self.encoded.add([new[i]], ids, np.array([len(ids)]))
        limit = SHORT
        while limit > 1:
            same = np.flatnonzero((own < 0) & (size <= limit) & (size > limit // 2)).tolist()
            limit //= 2
            if same:
                found = merged_together([raw[i] for i in same], self.byte_ids, self.pair_ranks)
                self.encoded.add([new[i] for i in same], *found)

    def _ids(self, matches: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of listed texts in a row, and how many each text has."""
        if self.encoded.bytes() > REMEMBERED_BYTES:
            self.encoded.empty()
        self._learn(set(chain.from_iterable(matches)))
        last = np.cumsum([len(pieces) for pieces in matches])
        flat, ends = self.encoded.ids(chain.from_iterable(matches), int(last[-1]))
        return flat, np.diff(np.concatenate([[0], ends])[last], prepend=0)

    def _matches(self, text: str) -> Iterator[str]:
        return (match.group() for match in self.pattern.finditer(text))

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Slices of texts: their ids in a row, and how many each text has."""
        matches: list[list[str]] = []
        chars = 0
        for text in texts:
            if matches and chars + len(text) > SLICE_CHARS:
                yield self._ids(matches)
                matches, chars = [], 0
            if len(text) > SLICE_CHARS:
                found = self._matches(text)
                parts = []
                while some := list(islice(found, SLICE_CHARS // 4)):
                    parts.append(self._ids([some])[0])
                whole = np.concatenate(parts)
                yield whole, np.array([len(whole)])
                continue
            grouped = self.pattern.groups
            matches.append(list(self._matches(text)) if grouped else self.pattern.findall(text))
            chars += len(text)
        if matches:
            yield self._ids(matches)

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of the tokens of each list; null if the list is, or one of its ids is no token."""
        first = np.frombuffer(lists.buffers()[1], dtype=np.int32)
        bounds = first[lists.offset : lists.offset + len(lists) + 1].astype(np.int64)
        ids = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
        bounds = bounds - bounds[0]
        flat = ids.fill_null(-1).to_numpy(zero_copy_only=False)
        known = (flat >= 0) & (flat < len(self.token_bounds) - 1)
        flat = np.where(known, flat, 0)
        begin = self.token_bounds[flat]
        size = np.where(known, self.token_bounds[flat + 1] - begin, 0)
        known &= size > 0
        ends = np.concatenate([[0], np.cumsum(size)])
        data = self.token_bytes[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], size)]
        strange = np.concatenate([[0], np.cumsum(~known)])[bounds]
        null = (np.diff(strange) > 0) | lists.is_null().to_numpy(zero_copy_only=False)
        texts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lists), [None, pa.py_buffer(ends[bounds]), pa.py_buffer(data)]
        )
        return pc.if_else(pa.array(null), pa.scalar(None, pa.large_binary()), texts).cast(pa.binary())


def _codec(path: str, pattern: str) -> Codec:
    codecs = worker_table("bytepairs")
    if (path, pattern) not in codecs:
        codecs[path, pattern] = Codec(path, pattern)
    return codecs[path, pattern]


def encode(
    documents: DataFrame, keep: list[str], ranks: str, pattern: str, text: str = "text"
) -> DataFrame:
    """``keep`` columns with ``n_tokens`` and ``ids`` of the whole text, without special tokens.

    ``ranks`` is the path of the file of ranks, at the same place on every machine.
    """
    rows = documents.select(*keep, text_column(documents, text).alias("__text"))
    schema = rows.drop("__text").schema.add("n_tokens", "long").add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for batch in batches:
            first = 0
            texts = (value.as_py() for value in batch.column(batch.num_columns - 1))
            for ids, counts in codec.encode(texts):
                kept = [c.slice(first, len(counts)) for c in batch.columns[:-1]]
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(counts, pa.int64()), lists], names=schema.names
                )
                first += len(counts)

    return rows.mapInArrow(run, schema)


def decode(
    encoded: DataFrame, keep: list[str], ranks: str, pattern: str, ids: str = "ids"
) -> DataFrame:
    """``keep`` columns with ``decoded``, the bytes that the tokens of ``ids`` stand for."""
    rows = encoded.select(*keep, F.col(ids).cast("array<int>").alias("__ids"))
    schema = rows.drop("__ids").schema.add("decoded", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            for first in range(0, batch.num_rows, DECODED_ROWS):
                kept = [c.slice(first, DECODED_ROWS) for c in batch.columns[:-1]]
                texts = codec.decode(lists.slice(first, DECODED_ROWS))
                yield pa.RecordBatch.from_arrays([*kept, texts], names=schema.names)

    return rows.mapInArrow(run, schema)
