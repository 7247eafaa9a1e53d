import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import near_copies as groups
from tidemark.llm import simhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, distance):
    """Least index reachable for each fingerprint."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    values = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance).tolist():
            a, b = sorted((find(i), find(j)))
            label[b] = a
    return [find(i) for i in range(len(prints))]


def near_copies(prose):
    rng, rows = random.Random(1), []
    for base in range(6):
        words = prose(base, 300).split()
        for _ in range(25):
            own = list(words)
            for _ in range(rng.randrange(5)):
                own[rng.randrange(len(own))] = f"q{rng.randrange(9)}"
            rows.append(" ".join(own))
    return rows + [prose(100 + k, 40) for k in range(100)]


def test_matches_brute_force(docs, prose, odd_texts):
    texts = odd_texts + near_copies(prose) + [prose(0, 300)] * 20 + ["  "]
    prints = [fingerprint(t) for t in texts]
    want = [(i, f"{p:016x}", c) for i, (p, c) in enumerate(zip(prints, classes(prints, 4)))]
    got = sorted(tuple(r) for r in simhash.near_duplicates(docs(list(enumerate(texts)))).collect())
    assert got == want


def test_hot_buckets_are_striped_without_loss(docs, prose, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 10)
    texts = near_copies(prose)
    prints = [fingerprint(t) for t in texts]
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs(list(enumerate(texts)))).collect())
    assert got == list(enumerate(classes(prints, 4)))


@pytest.mark.parametrize("distance", [0, 3, 4, 7, 10, 16])
def test_thresholds_keep_the_pigeonhole_sum(distance):
    rng = np.random.Generator(np.random.PCG64(1))
    spread = [rng.integers(1, 1000, 9).astype(float) for _ in range(8)]
    plan = simhash.plan_parts(list(range(64)), spread, 10**6, distance)
    used = {b for p, _ in plan.parts for b in p}
    assert all(t >= 0 for _, t in plan.parts)
    # Any way to spread the differing bits leaves one used part within its threshold.
    skipped = 64 - len(used)
    assert sum(t + 1 for _, t in plan.parts) == distance + 1 and skipped >= 0


@pytest.mark.parametrize("with_check", [False, True])
def test_links_need_few_rows(spark, monkeypatch, with_check):
    """Each fingerprint is dealt once for each slice, and links are those of all pairs."""
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 150)
    rng = np.random.Generator(np.random.PCG64(3))
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (600, 9), dtype=np.uint64)
    values = np.unique(base[rng.integers(0, 40, 600)] ^ np.bitwise_xor.reduce(flips[:, :9], axis=1)).view(np.int64)
    nodes = spark.createDataFrame(pa.table({"fp": pa.array(values)} | ({"check": pa.array(values)} if with_check else {})))
    slices = simhash._slices(len(values))
    assert slices == 4 and simhash._dealt(nodes, slices, nodes.columns).count() == slices * len(values)
    found = {r.fp: r.component for r in simhash._components(nodes, 10, 54 if with_check else None).collect()}
    want = classes(values.view(np.uint64).tolist(), 10)
    assert len(set(want)) < len(values)
    assert len(set(zip(map(found.get, values.tolist()), want))) == len(set(want)) == len(set(found.values()))


def test_plan_grows_less_than_pairs_do():
    """Ten times the fingerprints get longer parts, not a hundred times the pairs."""
    even = [np.array([1, 4, 6, 4, 1.0])] * 16
    costs = [simhash.plan_parts(list(range(64)), even, n, 10, simhash._slices(n)).cost for n in (250_000, 2_500_000)]
    assert costs[1] < 40 * costs[0] and costs[1] < 300


def test_chance_components_are_cut(spark, monkeypatch):
    """Of one large component only sets that may be similar are left, and those together."""
    monkeypatch.setattr(groups, "CHUNK", 4)
    rng = np.random.Generator(np.random.PCG64(4))
    common = rng.integers(-2**63, 2**63, 60)
    sets = [np.concatenate([common[:k % 60], rng.integers(-2**63, 2**63, 61 + k % 7)]) for k in range(80)]
    for k in range(0, 80, 4):
        sets.append(np.concatenate([sets[k][len(sets[k]) // 10:], rng.integers(-2**63, 2**63, 1 + k % 20)]))
    sets += [np.zeros(0, np.int64), common[:1]]
    rows = pa.table({
        "component": [0] * len(sets), "chunks": pa.array([26] * len(sets), pa.int32()), "chunk": pa.array([0] * len(sets), pa.int32()),
        "node": list(range(len(sets))), "members": pa.array([np.sort(s) for s in sets], pa.list_(pa.int64()))})
    cut = groups._cut(spark.createDataFrame(rows), 0.8)
    assert cut.columns == rows.column_names
    place = {r.node: r.component for r in cut.collect()}
    plain = [frozenset(s.tolist()) for s in sets]
    alike = [(i, j) for j in range(len(sets)) for i in range(j) if len(plain[i] & plain[j]) >= 0.8 * len(plain[i] | plain[j])]
    assert len(alike) > 5 and all(place[i] == place[j] for i, j in alike)
    assert len(place) < len(sets) / 2


def test_null_ids_and_repeated_rows(docs, prose):
    rows = [(None, prose(1, 50)), (None, prose(1, 50)), (7, prose(1, 50)), (7, prose(1, 50)), (None, "alone here"), (8, None)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(docs(rows)).collect())
    assert got == [(False, 7, 7), (False, 7, 7), (False, 8, 8), (True, 0, 0), (True, 0, 7), (True, 0, 7)]
    kept = simhash.one_of_each(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["7", "8", "None"]


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.one_of_each(docs([])).count() == 0


def test_one_of_each_finds_similar_texts_only(docs, prose):
    rows = [(k, prose(k, 200)) for k in range(40)]
    changed = [(100 + k, " ".join(w if i != 90 else "changed" for i, w in enumerate(prose(k, 200).split()))) for k in range(40)]
    kept = {r.doc_id for r in simhash.one_of_each(docs(rows + changed)).collect()}
    assert set(range(40)) <= kept and len(kept) <= 42


def similar_classes(texts, least, k=5):
    """Least index that links of exact Jaccard similarity reach."""
    words = [(t or "").translate(LOW).split() for t in texts]
    sets = [frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))) if w else frozenset() for w in words]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if (len(sets[i] & sets[j]) >= least * union) and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


def graded_copies(prose):
    """Texts around Jaccard 0.8 of one another: one word changed at places that are far apart, some chains, one large group."""
    rows = []
    for base in range(12):
        words = prose(700 + base, 120).split()
        for changes in range(8):
            rows.append(" ".join(f"z{base}x{i}" if i % 14 == 7 and i // 14 < changes else w for i, w in enumerate(words)))
    rng, words = random.Random(4), prose(800, 150).split()
    for _ in range(70):
        own = list(words)
        for _ in range(rng.randrange(6)):
            own[rng.randrange(len(own))] = f"q{rng.randrange(99)}"
        rows.append(" ".join(own))
    return rows + [prose(900 + k, 60) for k in range(30)] + ["a b", "A  b", "", None]


@pytest.mark.parametrize("chunk", [128, 6])
def test_one_of_each_decides_on_exact_jaccard(docs, prose, monkeypatch, chunk):
    monkeypatch.setattr(groups, "CHUNK", chunk)
    texts = graded_copies(prose)
    kept = sorted(r.doc_id for r in simhash.one_of_each(docs(list(enumerate(texts)))).collect())
    assert kept == sorted(set(similar_classes(texts, 0.8)))


def test_one_of_each_finds_candidates_by_fingerprints(docs, prose, monkeypatch):
    # Without min-hash keys the fingerprints alone must bring near copies together.
    monkeypatch.setattr("tidemark.llm.near_copies.BANDS", 0)
    monkeypatch.setattr("tidemark.llm.near_copies._band_keys", lambda hashes, begin: np.zeros((len(begin), 0), np.uint64))
    rows = [(k, prose(k, 400)) for k in range(12)]
    changed = [(100 + k, text + " and one more line") for k, text in rows]
    assert sorted(r.doc_id for r in simhash.one_of_each(docs(rows + changed)).collect()) == list(range(12))
