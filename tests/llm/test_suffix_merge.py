import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import suffix_merge
from tidemark.llm.queries import byte_digest


def brute(rows):
    texts = [(float("inf") if doc is None else doc, doc, (text or "").encode()) for doc, text in rows]
    first = {}
    for order, _, t in texts:
        for i in range(len(t) - 49):
            first[t[i:i + 50]] = min(first.get(t[i:i + 50], float("inf")), order)
    out = []
    for order, doc, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 49):
            if first[t[i:i + 50]] < order:
                gone[i:i + 50] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-1])[:-1]).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in byte_digest(suffix_merge.suffix_dedup(df)).collect()), key=repr)


def case(prose, odd_texts):
    rng = random.Random(5)
    rows = list(enumerate(odd_texts))
    shared = ["".join(rng.choice("abcdefé 中\n") for _ in range(60 + 9 * k)) for k in range(5)]
    for k in range(60):
        own = "".join(rng.choice("abcdefghij klmé") for _ in range(rng.randrange(10, 400)))
        for s in range(k % 4):
            at = rng.randrange(len(own) + 1)
            own = own[:at] + shared[rng.randrange(5)] + own[at:]
        rows.append((1000 - 7 * k, own))
    rows += [(5000, "Z" * 400), (5001, "x" + "Z" * 120 + "y"), (4999, "Z" * 49), (5002, "ab" * 90), (4998, "ba" * 40), (6000, "abc" * 100), (6001, "bca" * 20)]
    rows += [(2000 + k, rows[20][1]) for k in range(5)] + [(2000, rows[20][1]), (2001, rows[21][1]), (None, rows[22][1]), (None, rows[22][1])]
    rows += [(None, shared[0]), (2**63 - 1, shared[0]), (-2**63, shared[1]), (7000, shared[0][:49] + shared[1][-49:]), (7001, shared[2][:50]), (7002, shared[2][1:51])]
    # One prefix with many continuations
    rows += [(8000 + k, shared[3][:40] + "".join(rng.choice("pqrs") for _ in range(40))) for k in range(40)]
    return rows


def test_matches_brute_force(docs, prose, odd_texts):
    rows = case(prose, odd_texts)
    assert got(docs(rows)) == brute(rows)


@pytest.mark.parametrize("group", [None, 3])
def test_many_chunks_and_ranges(docs, prose, odd_texts, monkeypatch, group):
    for name, value in {"CHUNK_BYTES": 1500, "RANGE_BYTES": 3000, "SAMPLED_KEYS": 3, "STEP": 256}.items():
        monkeypatch.setattr(suffix_merge, name, value)
    rows = case(prose, odd_texts)
    if group:
        monkeypatch.setattr(suffix_merge, "GROUP", group)
    random.Random(2).shuffle(rows)
    assert got(docs(rows)) == brute(rows)


def packed(keys, owner=1):
    chunk = type("C", (), {"owner": lambda self, who: (who, np.zeros(len(who), bool))})()
    rows = np.array([list(k) for k in keys], np.uint8)
    run = suffix_merge.Keys(rows, np.full(len(rows), owner))
    return suffix_merge.Packed(suffix_merge._pack(run, chunk, 0, len(run.keys)))


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 13])
def test_loser_tree_merges_and_knows_common_prefixes(k):
    rng = random.Random(k)
    lists = [sorted({bytes(rng.choice(b"abc") for _ in range(9)) for _ in range(rng.randrange(1, 200))}) for _ in range(k)]
    found = list(suffix_merge.merged([packed(keys) for keys in lists]))
    assert [key for *_, key in found] == sorted(x for keys in lists for x in keys)
    assert all(lists[i][at] == key for i, at, _, key in found)
    before = b""
    for _, _, shared, key in found:
        assert shared == next((n for n, (x, y) in enumerate(zip(before, key)) if x != y), len(key) if before else 0)
        before = key


@pytest.mark.parametrize("width", [3, 8, 24, 30])
def test_order_of_byte_rows(width):
    rng = np.random.Generator(np.random.PCG64(width))
    rows, tie = rng.integers(0, 2, (500, width)).astype(np.uint8), rng.integers(0, 5, 500)
    found = suffix_merge._order(rows, tie)
    listed = [(rows[i].tobytes(), tie[i]) for i in found]
    assert sorted(found.tolist()) == list(range(500)) and listed == sorted(listed)


def test_spans_are_the_removed_bytes(docs):
    text = "é" + "0123456789" * 7
    found = {r.doc_id: ([(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_merge.suffix_dedup(docs([(1, text), (2, "ab" + text + "cd")])).collect()}
    assert found == {1: ([], text.encode()), 2: ([(2, 74)], b"abcd")}


def test_empty_table(docs):
    assert got(docs([])) == []


def test_blocks_are_stored_with_the_texts(spark, docs, tmp_path, prose, monkeypatch):
    (row,) = suffix_merge._store_chunks(docs([(k, prose(k, 200)) for k in range(5)]).coalesce(1), f"file://{tmp_path}").collect()
    chunk = suffix_merge.Chunk(row.path, None, [])
    want = suffix_merge._cut(chunk.data, chunk.offsets)
    monkeypatch.setattr(suffix_merge, "_anchors", None)
    assert len(want[0]) > 100 and all((a == b).all() for a, b in zip(chunk.cut, want))
