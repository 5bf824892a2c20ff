"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

A document's tokens, closed by ``end_id``, are cut at every ``capacity`` tokens; each such piece
fills a window. What remains is cut into pieces of at most ``piece`` tokens. Pieces are packed in
batches of ``batch_tokens`` tokens: with k windows for a batch, partial partitions of k sums are
merged, the largest difference first, the largest sums of one with the smallest of the other, so
imbalances cancel and the k windows come out nearly equal. k starts from the batch's tokens
divided by ``capacity`` and rises whenever a window exceeds it.

Every batch lies in one task, so there is no shuffle and no task holds more than one batch beside
its input; a task that is repeated gives the same windows. A window's number is the partition's
number and a count within it. The last batch of a partition may be small.

Null and empty text packs its end id alone. Repeated rows are packed each, null ids too. An empty
table gives no window. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import gc
import heapq
import json
import os
import zlib
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tarmac.llm.shared import bound_batches, release_memory, text_column, worker_table

CAPACITY = 1024
PIECE = 256
#: Tokens of the pieces that are balanced together; bounds memory and work of one differencing.
BATCH_TOKENS = 128 * 1024
#: Texts tokenised together, and tokens that leave together, in whole pieces.
SLICE_CHARS = 1 << 20
OUT_TOKENS = 1 << 18

#: The public pre-tokenisation pattern of byte-level encodings: a fixed value.
_PRETOKENS = (
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


class ChunkIds(dict):
    """Chunk of text to its row: ``flat[bounds[row] : bounds[row + 1]]`` are its ids.

    Byte-level pre-tokenisers part a text before each blank that stands between other characters,
    so chunks may be encoded on their own, and the many that repeat only once. A chunk stands for
    itself after a blank, unless it starts with a line break or with ``BARE``.
    """

    #: Bytes that one worker remembers, estimated; then it starts anew.
    LIMIT = 64 << 20
    ENTRY = 150
    BARE = "\x01"

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.bounds = np.zeros(1 << 14, dtype=np.int64)

    def learn(self, chunks: set[str]) -> None:
        """Encodes the chunks that are not yet known."""
        if self.ENTRY * len(self) + 4 * int(self.bounds[len(self)]) > self.LIMIT:
            self.clear()
        new = list(chunks - self.keys())
        encode, bare = self.encode, self.BARE
        # Very many short lists, which no garbage collection need look at.
        gc.disable()
        found = [
            encode(" " + c if c[0] not in ("\n", bare) else c[1:] if c[0] == bare else c) for c in new
        ]
        gc.enable()
        first, used = len(self), int(self.bounds[len(self)])
        ends = used + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        if not new:
            return
        last = first + len(new)
        self.flat = _with_room(self.flat, int(ends[-1]))
        self.bounds = _with_room(self.bounds, last + 1)
        self.flat[used : ends[-1]] = np.fromiter(
            chain.from_iterable(found), np.uint32, int(ends[-1]) - used
        )
        self.bounds[first + 1 : last + 1] = ends
        self.update(zip(new, range(first, last)))


def _with_room(table: np.ndarray, size: int) -> np.ndarray:
    """The table, or a copy of at least twice its length, so that ``size`` entries fit."""
    if size <= len(table):
        return table
    larger = np.zeros(max(size, 2 * len(table)), dtype=table.dtype)
    larger[: len(table)] = table
    return larger


class Encoder:
    """Token ids as the public tokenizer of ``path`` gives them, without special tokens added."""

    def __init__(self, path: str):
        self.path = path
        self.chunks = ChunkIds(_ranked(path) or self._whole)
        with open(path, encoding="utf-8") as file:
            self.marks = [t["content"] for t in json.load(file).get("added_tokens", [])]
        # Reading the file took more memory than what is kept of it.
        release_memory()

    @cached_property
    def tokenizer(self):
        """Only texts that are encoded whole need it, so it is loaded with the first of them."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _chunks(self, text: str) -> list[str] | None:
        """The chunks of a text, or null if it must be encoded whole.

        That is so for texts with control characters, or blanks other than space and line break,
        which parsers may treat differently, for those with runs of blanks, with blanks at either
        end, and with the mark of a special token.
        """
        if not text.replace("\n", "").isprintable() or any(mark in text for mark in self.marks):
            return None
        chunks = text.replace("\n", " \n").split(" ")
        return None if "" in chunks or "\n" in chunks else chunks

    def __call__(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each closed by ``end_id``, and where each text ends."""
        chunks: list[str] = []
        counts, odd = [], {}
        for i, text in enumerate(texts):
            own = self._chunks(text) if text else []
            if own is None:
                odd[i] = np.array(self._whole(text), dtype=np.uint32)
                own = []
            elif own:
                own[0] = ChunkIds.BARE + own[0]
            chunks += own
            counts.append(len(own))
        self.chunks.learn(set(chunks))
        flat, bounds = self.chunks.flat, self.chunks.bounds
        at = np.fromiter(map(self.chunks.__getitem__, chunks), np.int64, len(chunks))
        begin = bounds[at]
        size = bounds[at + 1] - begin
        ends = np.cumsum(size)
        ids = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)]
        text_ends = np.concatenate([[0], ends])[np.cumsum(counts)].astype(np.int64)
        if odd:
            sizes = np.zeros(len(texts), dtype=np.int64)
            sizes[list(odd)] = [len(x) for x in odd.values()]
            where = text_ends[list(odd)]
            ids = np.insert(
                ids, np.repeat(where, sizes[list(odd)]), np.concatenate(list(odd.values()))
            )
            text_ends = text_ends + np.cumsum(sizes)
        closed = np.insert(ids, text_ends, end_id)
        return closed, text_ends + np.arange(1, len(texts) + 1)


def _ranked(path: str):
    """An equal but faster encoder for chunks, if the file's ids are the ranks of its merges."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    plain = spec["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel"
    if not plain or pre.get("add_prefix_space") or spec.get("normalizer"):
        return None
    vocabulary = spec["model"]["vocab"]
    special = {t["content"] for t in spec.get("added_tokens", [])}
    merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
    if any(vocabulary.get(m.replace(" ", "", 1)) != 256 + i for i, m in enumerate(merges)):
        return None
    # Byte-level files write each byte as one printable character.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in vocabulary.items()
        if token not in special
    }
    encoding = tiktoken.Encoding("chunks", pat_str=_PRETOKENS, mergeable_ranks=ranks, special_tokens={})
    return encoding._core_bpe.encode_ordinary


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: the items of each of ``windows`` windows of nearly equal sums."""
    if windows == 1 or len(sizes) <= windows:
        whole = [[i] for i in range(len(sizes))] if len(sizes) <= windows else []
        return whole if whole or not sizes else [list(range(len(sizes)))]
    # A partial partition keeps its non-empty windows, by falling sum less the smallest; each
    # window is a node whose children are the nodes it was merged from.
    children: list[tuple[int, int] | int] = list(range(len(sizes)))
    heap = [(-s, i, np.array([s]), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, sums2, nodes2 = heapq.heappop(heap)
        overlap = len(sums) + len(sums2) - windows
        if overlap <= 0:
            sums, nodes = np.concatenate([sums, sums2]), np.concatenate([nodes, nodes2])
        else:
            # Largest with smallest: the last windows of one meet the last of the other, reversed.
            a, b = len(sums) - overlap, len(sums2) - overlap
            joined = np.arange(len(children), len(children) + overlap)
            children.extend(zip(nodes[a:].tolist(), nodes2[b:][::-1].tolist()))
            sums = np.concatenate([sums[:a], sums2[:b], sums[a:] + sums2[b:][::-1]])
            nodes = np.concatenate([nodes[:a], nodes2[:b], joined])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        if len(sums) == windows:
            sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), tie, sums, nodes))
        tie += 1
    out = []
    for node in heap[0][3].tolist():
        items, todo = [], [node]
        while todo:
            child = children[todo.pop()]
            if isinstance(child, int):
                items.append(child)
            else:
                todo.extend(child)
        out.append(sorted(items))
    return out


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises until the differencing fits."""
    total = sum(sizes)
    windows = max(1, -(-total // capacity))
    while True:
        found = differencing(sizes, windows)
        if all(sum(sizes[i] for i in w) <= capacity for w in found):
            return found
        windows += max(1, windows // 400)


class Packer:
    """Pieces of one partition: full windows at once, the rest in batches."""

    def __init__(self, capacity: int, piece: int, batch_tokens: int, first: int):
        self.capacity, self.piece, self.batch_tokens = capacity, piece, batch_tokens
        self.next = first
        self.waiting: list[tuple] = []
        self.tokens = 0

    def add(self, key, ids: np.ndarray) -> Iterator[tuple]:
        """Pieces that are ready: (key, start, ids, tokens of the document, window, offset)."""
        n = len(ids)
        whole = n - n % self.capacity
        for start in range(0, whole, self.capacity):
            yield key, start, ids[start : start + self.capacity], n, self.next, 0
            self.next += 1
        for start in range(whole, n, self.piece):
            part = ids[start : min(start + self.piece, n)]
            self.waiting.append((key, start, part, n))
            self.tokens += len(part)
            if self.tokens >= self.batch_tokens:
                yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        for window in pack([len(p[2]) for p in self.waiting], self.capacity) if self.waiting else []:
            offset = 0
            for i in window:
                yield *self.waiting[i], self.next, offset
                offset += len(self.waiting[i][2])
            self.next += 1
        self.waiting, self.tokens = [], 0


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    batch_tokens: int = BATCH_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``tokenizer`` is the path of a byte-level tokenizer file, at the same place on every machine.
    Each window is filled without gaps from offset 0; ``ids`` is null without ``with_ids``.
    """
    bound_batches(documents.sparkSession)
    rows = documents.select(doc_id, text_column(documents, text).alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, ids array<int>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = worker_table("packing")
        encoder = encoders.get(tokenizer)
        if encoder is None:
            encoder = encoders[tokenizer] = Encoder(tokenizer)
        packer = Packer(capacity, piece, batch_tokens, TaskContext.get().partitionId() << 36)
        out: list[tuple] = []
        tokens = 0
        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for keys, texts in _slices(batch):
                ids, ends = encoder(texts, end_id)
                for key, first, last in zip(keys, [0, *ends.tolist()], ends.tolist()):
                    for ready in packer.add(key, ids[first:last]):
                        out.append(ready)
                        tokens += len(ready[2])
                    if tokens >= OUT_TOKENS:
                        yield _batch(out, key_type, with_ids)
                        out, tokens = [], 0
        out.extend(packer.flush())
        if out:
            yield _batch(out, key_type, with_ids)

    return rows.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    keys, texts, size = [], [], 0
    for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
        text = value.as_py() or ""
        keys.append(key)
        texts.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _batch(pieces: list[tuple], key_type: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    keys, starts, ids, totals, windows, offsets = zip(*pieces)
    sizes = np.array([len(i) for i in ids], dtype=np.int32)
    if with_ids:
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        flat = np.concatenate(ids).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
    else:
        lists = pa.nulls(len(ids), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys, key_type),
            pa.array(starts, pa.int64()),
            pa.array(sizes, pa.int64()),
            pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()),
            pa.array(totals, pa.int64()),
            pa.array(windows, pa.int64()),
            pa.array(offsets, pa.int64()),
            lists,
        ],
        names=[
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids",
        ],
    )
