"""Fill-in-the-middle against units listed one by one; byte pairs against the public library."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import edge_rows, frame, rows
from pyspark.sql import functions as F

from tarmac.llm import bytepairs, fillmiddle

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CODER = RANKS, public_tokenizers.PATTERN


def plainly(key, text):
    """(n, form, output, prefix_chars, middle_chars) by the definition."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", text, None, None
    if h4 % 100 < 80:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def odd_texts():
    rng = random.Random(3)
    pieces = [" ", "\n", "\t", "\x0b", "\r\n", "é", "日本", "😀", "a", "word", " ", " ", "<", ">", "P>", "\x00"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(400)]
    return [*texts, "<P>", "a <S> b", "x<M>", " ", "\n\n", "<S", "S>", "x" * 70, " x" * 3000, "é" * 5000]


def test_middle_equals_units_listed(spark):
    docs = [*edge_rows(), *enumerate(odd_texts(), 100), (-5, "negative id here")]
    made = fillmiddle.fill_in_middle(frame(spark, docs), ["doc_id"])
    made = made.withColumn("again", fillmiddle.restored(F.col("form"), F.col("output")))
    want = [(k, *plainly(k, t), t or "") for k, t in docs]
    got = rows(made, "doc_id", "n", "form", "output", "prefix_chars", "middle_chars", "again")
    assert got == sorted(want, key=repr)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


@pytest.mark.parametrize("last", ["", " ", "x", "é"])
def test_a_cut_at_the_end_of_a_slice_of_any_size(last):
    for size in range(140):
        texts = ["a " * (size // 2) + "b" * (size % 2), last]
        raw = [t.encode() for t in texts]
        offsets = np.cumsum([0, *map(len, raw)])
        units = fillmiddle.Units(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
        listed = [UNIT.findall(t) for t in texts]
        assert units.count.tolist() == [len(x) for x in listed]
        for taken in (0, 1, 3, 200):
            places = units.cut(np.minimum(taken, units.count)).tolist()
            ends = [len("".join(x[:taken]).encode()) for x in listed]
            assert places == [a + b for a, b in zip(offsets.tolist(), ends)]


def test_middle_keeps_columns_and_rows(spark, edges, empty):
    keep = [c for c in edges.columns if c not in ("n", "text")]
    made = fillmiddle.fill_in_middle(edges, keep)
    assert made.columns[: len(keep)] == keep
    assert made.count() == edges.count()
    assert fillmiddle.fill_in_middle(empty, ["doc_id"]).count() == 0


def test_rates_are_followed(spark):
    docs = frame(spark, [(i, "one two three") for i in range(3000)])
    shares = {
        r.form: r["count"] / 3000
        for r in fillmiddle.fill_in_middle(docs, ["doc_id"], rate=90, spm_rate=20).groupBy("form").count().collect()
    }
    assert abs(shares["plain"] - 0.1) < 0.03 and abs(shares["spm"] - 0.18) < 0.03


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=300), st.integers(0, 300))
def test_ranks_of_the_wavelet_matrix(symbols, place):
    array = np.array(symbols, dtype=np.uint8)
    place = min(place, len(symbols))
    matrix = fillmiddle.WaveletMatrix(array)
    for symbol in range(6):
        assert matrix.rank(symbol, np.array([place]))[0] == symbols[:place].count(symbol)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bytepairs.read_ranks(RANKS),
        special_tokens={},
    )


def test_ids_equal_the_library(spark, library):
    rng = random.Random(9)
    long = ["".join(rng.choice("abcdefghé") for _ in range(20_000)), "a" * 3001, " " * 700, "word " * 30_000]
    docs = [*edge_rows(), *enumerate([*odd_texts(), *long, "<|endoftext|> it's"], 100)]
    found = bytepairs.encode(frame(spark, docs), ["doc_id"], *CODER)
    back = bytepairs.decode(found, ["doc_id", "n_tokens", "ids"], *CODER)
    want = []
    for k, text in docs:
        ids = library.encode_ordinary(text or "")
        want.append((k, len(ids), ids, bytearray((text or "").encode())))
    assert rows(back, "doc_id", "n_tokens", "ids", "decoded") == sorted(want, key=repr)


def texts_of(codec, texts):
    """The ids of each text, from slices of texts."""
    out = []
    for ids, counts in codec.encode(texts):
        out += [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
    return out


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40) | st.text("ab ", max_size=60).map(str.encode))
def test_merges_equal_the_library(library, piece):
    want = library._core_bpe.encode_single_piece(piece) if piece else []
    assert bytepairs.merged_parts(piece, library._mergeable_ranks) == want


@pytest.fixture(scope="module")
def codec():
    return bytepairs.Codec(*CODER)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=2, max_size=40), min_size=1, max_size=30))
def test_merges_of_many_equal_those_of_one(codec, pieces):
    pieces = [p for p in pieces if p not in codec.ranks] or [b"\x00\x00\xff"]
    ids, counts = bytepairs.merged_together(pieces, codec.byte_ids, codec.pair_ranks)
    want = [bytepairs.merged_parts(p, codec.ranks) for p in pieces]
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_ranks_of_pairs(codec):
    rng = np.random.default_rng(4)
    first, second = rng.integers(0, 50_256, (2, 20_000))
    tokens = sorted(codec.ranks, key=codec.ranks.__getitem__)
    want = [
        codec.ranks.get(tokens[a] + tokens[b], bytepairs._NONE)
        for a, b in zip(first.tolist(), second.tolist())
    ]
    assert codec.pair_ranks(first, second).tolist() == want
    some = [(codec.ranks[t[:1]], codec.ranks[t[1:]], r) for t, r in codec.ranks.items() if t[1:] in codec.ranks and len(t) > 1]
    a, b, ranks = (np.array(x) for x in zip(*some))
    assert codec.pair_ranks(a, b).tolist() == ranks.tolist()


@pytest.mark.parametrize("limits", [{}, {"REMEMBERED_BYTES": 2000, "SLICE_CHARS": 500}, {"SLICE_CHARS": 8}, {"SHORT": 1}])
def test_limits_change_nothing(library, monkeypatch, limits):
    """A table that is emptied, small slices, texts listed in parts, and matches one by one."""
    for name, value in limits.items():
        monkeypatch.setattr(bytepairs, name, value)
    codec = bytepairs.Codec(*CODER)
    texts = odd_texts()
    assert texts_of(codec, texts) == [library.encode_ordinary(t) for t in texts]
    assert texts_of(codec, []) == []
    if "REMEMBERED_BYTES" in limits:
        assert codec.encoded.bytes() < 40_000


def test_decoding_of_odd_lists(spark):
    lists = spark.createDataFrame(
        [(1, None), (2, []), (3, [None]), (4, [50_256]), (5, [-1, 64]), (6, [64, 65])],
        "id int, ids array<int>",
    )
    found = bytepairs.decode(lists, ["id"], *CODER)
    assert rows(found) == [(1, None), (2, bytearray()), (3, None), (4, None), (5, None), (6, bytearray(b"ab"))]


def test_slices_lose_no_row(spark, library):
    texts = [(i, "some words here " * (i % 7)) for i in range(500)] + [(1000, "long text " * 150_000), (1001, None)]
    found = bytepairs.encode(frame(spark, texts).coalesce(1), ["doc_id", "n"], *CODER)
    want = [(i, len(library.encode_ordinary(t or ""))) for i, t in texts]
    assert rows(found, "doc_id", "n_tokens") == sorted(want, key=repr)
