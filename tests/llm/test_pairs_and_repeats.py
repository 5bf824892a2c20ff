"""Jaccard join, line dedup and byte dedup against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest


from tarmac.llm import deepshallow, jaccard, linededup, suffixdedup
from tarmac.llm.components import components
from tarmac.llm.shared import Stage, key_filter

from llm_data import edge_rows, frame, rows, words

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def classes(table):
    """(doc_id, set size, class) of each row, from all pairs."""
    sets = [shingles(t) for _, t in table]
    root = list(range(len(table)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and 100 * both >= 80 * len(s | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (doc, _) in enumerate(table):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    return [(d, len(s), None if d is None else least[find(k)]) for k, ((d, _), s) in enumerate(zip(table, sets))]


def near_copies(rng):
    table, doc = [], 0
    passage = words(rng, 80)
    for _ in range(12):
        base = words(rng, rng.choice([3, 5, 40, 120, 300]), 3000)
        if rng.random() < 0.5:
            base[5:5] = passage
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 30)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(999)}"
            table.append((doc, " ".join(copy)))
            doc += 1
    return table


@pytest.mark.parametrize("seed, heavy, rounds", [(1, 1 << 17, 2), (2, 1, 0), (3, 50, 1)])
def test_classes_equal_all_pairs(spark, monkeypatch, seed, heavy, rounds):
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", rounds)
    table = near_copies(random.Random(seed))
    found = jaccard.near_duplicates(frame(spark, table), heavy=heavy)
    want = sorted(classes(table), key=repr)
    assert rows(found, "doc_id", "n_shingles", "component_id") == want


def test_jaccard_edges(spark, edges, empty):
    found = jaccard.near_duplicates(edges)
    want = []
    for (doc, text), row in zip(edge_rows(), classes(edge_rows())):
        want.append(row if shingles(text) or doc is None else (doc, 0, doc))
    assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    assert jaccard.near_duplicates(empty).count() == 0


def test_one_of_each_class_stays(spark, edges):
    kept = jaccard.keep_one(edges)
    assert kept.columns == edges.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    # 5 and 6 are copies of 4, 8 of 7, 14 of 13; null ids stay; both texts of 9 stay.
    assert ids == sorted([1, 2, 3, 4, 7, 9, 9, 10, 11, 12, 13, None, None], key=repr)


def test_links_through_texts_without_id(spark):
    """1 and 3 are linked only by way of a text whose rows have no id."""
    w = [f"w{k}" for k in range(100)]
    table = [(1, " ".join(w[:88])), (None, " ".join(w)), (3, " ".join(w[12:]))]
    plain = classes(table)
    assert [c for _, _, c in plain] == [1, None, 1]
    assert not any(100 * len(a & b) >= 80 * len(a | b) for a, b in [(shingles(table[0][1]), shingles(table[2][1]))])
    found = jaccard.near_duplicates(frame(spark, table))
    assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(plain, key=repr)
    assert [r.doc_id for r in jaccard.keep_one(frame(spark, table)).orderBy("doc_id").collect()] == [None, 1]


def test_near_copies_that_share_an_id(spark):
    base = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    table = [(1, base), (1, base + " end"), (1, base), (1, other), (2, base + " more"), (2, "unlike"), (3, other)]
    kept = sorted((r.doc_id, r.text) for r in jaccard.keep_one(frame(spark, table)).collect())
    texts = {base, base + " end", base + " more"}
    assert len([t for d, t in kept if t in texts]) == 1 and all(d == 1 for d, t in kept if t in texts)
    assert [(d, t) for d, t in kept if t not in texts] == [(1, other), (2, "unlike")]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"), Stage(spark, "test"))
    want = [(i, 0) for i in range(41)] + [(x, 100) for x in range(100, 140)]
    assert rows(found, "node", "root") == sorted(want, key=repr)


@pytest.mark.parametrize("largest, wrong", [(28, 0.05), (10, 1.0)])
def test_filter_never_misses(spark, largest, wrong):
    keys = np.random.default_rng(1).integers(-(2**62), 2**62, 5000)
    found = key_filter(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k", largest)
    assert found.maybe(keys).all()
    others = np.random.default_rng(2).integers(-(2**62), 2**62, 5000)
    assert found.maybe(others).mean() <= wrong
    none = key_filter(spark.createDataFrame([], "k long"), "k")
    assert not none.maybe(keys).any()


def without_runs(table, min_lines=2, min_words=50):
    """(doc_id, text) with later copies of runs, and of long lines, deleted; table in order of place."""
    places, gone = {}, {k: set() for k in range(len(table))}
    for k, (_, text) in enumerate(table):
        lines = [(j, x) for j, x in enumerate((text or "").split("\n")) if x.strip(" ")]
        for i in range(len(lines) - min_lines + 1):
            run = tuple(x for _, x in lines[i : i + min_lines])
            if places.setdefault(run, (k, i)) != (k, i):
                gone[k] |= {j for j, _ in lines[i : i + min_lines]}
        for i, (j, line) in enumerate(lines):
            enough = len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= min_words
            if enough and places.setdefault(line, (k, i)) != (k, i):
                gone[k].add(j)
    out = []
    for k, (doc, text) in enumerate(table):
        kept = None if text is None else "\n".join(
            x for j, x in enumerate(text.split("\n")) if j not in gone[k]
        )
        out.append((doc, kept, len(gone[k])))
    return out


@pytest.mark.parametrize("min_lines", [1, 2, 3, 4])
def test_line_runs_equal_brute_force(spark, min_lines):
    rng = random.Random(min_lines)
    pool = [f"line {k}" for k in range(9)]
    table = []
    for doc in range(40):
        lines = [rng.choice(pool) if rng.random() < 0.7 else f"own {doc} {k}" for k in range(rng.randrange(1, 25))]
        table.append((doc, "\n".join(lines)))
    table.append((40, table[3][1]))
    found = linededup.remove_repeated_lines(frame(spark, table), min_lines=min_lines)
    want = sorted(without_runs(table, min_lines), key=repr)
    assert rows(found, "doc_id", "text", "n_removed") == want


def test_long_lines_are_runs_by_themselves(spark):
    rng = random.Random(5)
    long, short = " ".join(words(rng, 50)), " ".join(words(rng, 49))
    table = [
        (1, f"own 1\n{long}\nown 2\n{short}"), (2, f"own 3\n{short}\nown 4\n{long}\nown 5"),
        (3, long), (4, short), (5, f"{long}\n{long}"), (6, f"  {long}"),
    ]
    found = linededup.remove_repeated_lines(frame(spark, table))
    assert rows(found, "doc_id", "text", "n_removed") == sorted(without_runs(table), key=repr)
    texts = {r.doc_id: (r.text, r.longest_run) for r in found.collect()}
    assert texts[2] == (f"own 3\n{short}\nown 4\nown 5", 1) and texts[3] == ("", 1)
    assert texts[4] == (short, 0) and texts[5] == ("", 2) and texts[6][0] == f"  {long}"
    few = linededup.remove_repeated_lines(frame(spark, table), min_words=49)
    want = sorted(without_runs(table, min_words=49), key=repr)
    assert rows(few, "doc_id", "text", "n_removed") == want


def test_rows_that_repeat_enter_once(spark):
    """Fifty equal rows whose lines occur elsewhere too; tables hold one row per line and place."""
    rng = random.Random(6)
    run = [f"shared {k}" for k in range(9)]
    other = [(k, "\n".join([f"own {k}", *run[k % 4 : 4 + k % 5], f"end {k}"])) for k in range(100, 140)]
    copied = (7, "\n".join(["first", *run, "last"]))
    table = [copied] * 50 + other + [(None, copied[1])] * 50
    rng.shuffle(table)
    sizes = {}

    class Counted(Stage):
        def table(self, name, df):
            out = super().table(name, df)
            sizes[name] = out.count()
            return out

    original, linededup.Stage = linededup.Stage, Counted
    try:
        found = rows(linededup.remove_repeated_lines(frame(spark, table)), "doc_id", "text", "n_removed")
    finally:
        linededup.Stage = original
    once = [(None, copied[1]), copied, *sorted(other)]
    plain = {(d, t): kept for (d, t), kept in zip(once, without_runs(once))}
    assert found == sorted((plain[d, t] for d, t in table), key=repr)
    lines = sum(t.count("\n") + 1 for _, t in once)
    assert sizes["positions"] == lines and max(sizes.values()) <= lines


@pytest.mark.parametrize("bits", [25, 15])
def test_bitmap_of_documents_never_misses(spark, monkeypatch, bits):
    monkeypatch.setattr(linededup, "BITMAP_BITS", bits)
    keys = spark.range(0, 4000).selectExpr("xxhash64(id) as k")
    others = spark.range(4000, 8000).selectExpr("xxhash64(id) as k")
    bitmap = linededup._bitmap(keys, "k")
    assert keys.where(linededup._maybe(bitmap, "k")).count() == 4000
    wrong = others.where(linededup._maybe(bitmap, "k")).count()
    assert wrong < (5 if bits == 25 else 700)
    none = linededup._bitmap(keys.limit(0), "k")
    assert keys.where(linededup._maybe(none, "k")).count() == 0


def test_line_dedup_edges(spark, edges, empty):
    found = {}
    for r in linededup.remove_repeated_lines(edges).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, found.values())) == len(edge_rows())
    assert found[1][0].text is None and found[2][0].text == "" and found[3][0].text == " \n\t\n "
    assert found[11][0].text == "same line here" and found[11][0].longest_run == 29
    assert found[7][0].n_removed == 0 and found[8][0].text == ""
    # A line of 60 words: the null id comes first, equal rows are answered alike.
    assert [r.text for r in found[4]] == ["", ""] and found[5][0].text == ""
    assert sorted((r.text for r in found[None]), key=repr) == sorted([None, edge_rows()[3][1]], key=repr)
    assert linededup.remove_repeated_lines(empty).count() == 0


def removed(table, width):
    count = Counter()
    texts = [(t or "").encode() for _, t in table]
    for b in texts:
        for i in range(len(b) - width + 1):
            count[b[i : i + width]] += 1
    out = []
    for (doc, _), b in zip(table, texts):
        covered = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - width + 1):
            if count[b[i : i + width]] > 1:
                covered[i : i + width] = True
        kept = bytes(x for x, c in zip(b, covered) if not c)
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out.append((doc, len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("seed, group", [(1, 128), (2, 2), (3, 1)])
def test_byte_repeats_equal_brute_force(spark, seed, group):
    rng = random.Random(seed)
    passage = "".join(rng.choice("abcd ") for _ in range(400))
    table = []
    for doc in range(30):
        text = "".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(0, 500)))
        if rng.random() < 0.6:
            a = rng.randrange(0, 200)
            at = rng.randrange(len(text) + 1)
            text = text[:at] + passage[a : a + rng.randrange(30, 300)] + text[at:]
        if rng.random() < 0.3:
            text += text[len(text) // 3 :]
        if rng.random() < 0.2:
            text += "xy" * 60
        table.append((doc, text))
    table.append((30, table[4][1]))
    found = suffixdedup.remove_repeats(frame(spark, table), width=50, gram=12, group=group)
    assert rows(found, *COLUMNS) == removed(table, 50)


def test_byte_repeats_edges(spark, edges, empty):
    found = suffixdedup.remove_repeats(edges)
    assert rows(found, *COLUMNS) == removed(edge_rows(), 200)
    assert suffixdedup.remove_repeats(empty).count() == 0


def test_copies_do_not_wait_in_a_task():
    """Many tasks may send the same context of a gram; one row of each is held."""
    a, b = b"x" * 100 + b"y" * 200, b"z" * 100 + b"y" * 200
    names = ["gram", "ctx", "l", "bytes"]

    def batches():
        for ctx, piece in [(1, a)] * 20 + [(2, b)]:
            columns = ([5] * 10_000, [ctx] * 10_000, [100] * 10_000, [piece] * 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    tracemalloc.start()
    found = [r for out in suffixdedup._sorted_groups(200)(batches()) for r in out.to_pylist()]
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sorted((r["gram"], r["ctx"], r["l"], r["r"]) for r in found) == [(5, 1, 0, 200), (5, 2, 0, 200)]
    assert most < 30 << 20


def test_a_task_sends_a_context_once(spark):
    """Copies of a text and a near copy: pieces of different contexts only."""
    rng = random.Random(7)
    base = "".join(rng.choice("abcdefgh ") for _ in range(400))
    table = [(k, base) for k in range(60)] + [(60, base[:250] + "changed" + base[250:])]
    sizes = {}

    class Counted(Stage):
        def table(self, name, df):
            out = super().table(name, df)
            if name == "pieces":
                sizes[name] = out.count(), out.select("gram", "ctx").distinct().count()
            return out

    texts = frame(spark, table).coalesce(1).selectExpr("xxhash64(text) as t", "text")
    spans = suffixdedup.repeated_spans(texts, Counted(spark, "test"), 50, 12, 128)
    assert spans.count() == 2
    rows_, different = sizes["pieces"]
    assert rows_ == different > 0


def test_contexts_of_large_groups_are_sorted_once_few_agree(spark, monkeypatch):
    """A gram of many contexts, of which two at a time agree on more: bytes are not staged by the round."""
    rng = random.Random(11)

    def letters(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    common, table = letters(30), []
    for pair in range(20):
        passage = letters(20) + common + letters(20)
        table += [(2 * pair + k, letters(60) + passage + letters(60)) for k in range(2)]
    staged = []

    class Counted(Stage):
        def table(self, name, df):
            out = super().table(name, df)
            if "bytes" in df.columns:
                staged.append((name, out.count()))
            return out

    monkeypatch.setattr(suffixdedup, "Stage", Counted)
    found = suffixdedup.remove_repeats(frame(spark, table), width=50, gram=12, group=4)
    assert rows(found, *COLUMNS) == removed(table, 50)
    pieces = dict(staged)["pieces"]
    assert pieces >= 40 and sum(n for name, n in staged if name != "pieces") <= 2 * pieces


def test_bytes_of_large_groups_go_to_a_task_once_for_all_parts(spark, monkeypatch):
    rng = random.Random(12)

    def letters(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    common = letters(30)
    table = [(k, letters(60) + common + letters(60)) for k in range(40)]
    table += [(40 + k, table[k][1][:100] + letters(30)) for k in range(6)]
    docs, moved = frame(spark, table), {"contexts": 0, "sent": 0}
    plain = type(docs).mapInArrow

    def counted(self, f, schema, *args, **more):
        if {"bytes", "ctx"} <= set(self.columns):
            moved["sent"] += self.count()
        return plain(self, f, schema, *args, **more)

    class Counted(Stage):
        def table(self, name, df):
            out = super().table(name, df)
            if name == "rest-0":
                moved["contexts"] = out.count()
            return out

    monkeypatch.setattr(type(docs), "mapInArrow", counted)
    monkeypatch.setattr(suffixdedup, "Stage", Counted)
    found = suffixdedup.remove_repeats(docs, width=50, gram=12, group=4)
    assert rows(found, *COLUMNS) == removed(table, 50)
    print(moved)
    assert moved["contexts"] >= 40 and moved["sent"] <= 2 * moved["contexts"]


@pytest.mark.parametrize("seed", range(20))
def test_runs_of_spans(seed):
    rng = random.Random(seed)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    table = []
    for _ in range(rng.randrange(6)):
        firsts = [rng.randrange(30) for _ in range(rng.randrange(6))]
        table.append(rng.choice([None, [{"first": a, "last": a + rng.randrange(1, 9)} for a in firsts]]))
    begins, firsts, lasts = suffixdedup._runs(pa.array(table, kind))
    for i, spans in enumerate(table):
        covered = {b for s in spans or [] for b in range(s["first"], s["last"])}
        want = [b for b in range(40) if (b in covered) != (b - 1 in covered)]
        got = [b for k in range(begins[i], begins[i + 1]) for b in (firsts[k], lasts[k])]
        assert got == want


def test_what_strings_begin_with_is_passed_over(monkeypatch):
    """Contexts of a gram agree on all its bytes; these count for nothing in the shallow depth."""
    strings = [b"begins alike" * 9 + bytes([a, b]) for a in (3, 1, 2) for b in (8, 9, 7)] + [b"begins alike" * 9]
    monkeypatch.setattr(deepshallow, "_BlindTrie", None)
    assert [strings[i] for i in deepshallow.sort(strings)] == sorted(strings)


def test_deep_shallow_order():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    strings += [b"ab" * 40 + s for s in strings[:60]] + [b"", b"ab" * 40]
    order = deepshallow.sort(strings, shallow=6)
    assert sorted(order) == list(range(len(strings)))
    assert [strings[i] for i in order] == sorted(strings)
    prefixes = deepshallow.common_prefixes(strings[:40])
    for i in range(40):
        for j in range(40):
            if i != j:
                a, b = strings[i], strings[j]
                want = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                assert prefixes[i, j] == want


def test_a_worker_keeps_one_operator_s_tables():
    from tarmac.llm import shared

    mine = shared.worker_table("one")
    mine["key"] = 1
    assert shared.worker_table("one") is mine
    assert shared.worker_table("two") == {} == shared.worker_table("one")
