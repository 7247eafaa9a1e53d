import hashlib
import random
import zlib

import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, path long, n_convs long"


def brute(rows):
    """Rows (conv_id, turn, role, text) to the trie's nodes."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(w)] for c, w in convs.items()}
    rebuilt = {}
    for c, w in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = tuple(convs.get(family, [])[:h] + w[h:])
    members = {}
    for c, w in rebuilt.items():
        for d in range(len(w) + 1):
            members.setdefault(w[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def subtree(p):
        found, left = [], [p]
        while left:
            q = left.pop()
            found.append(q)
            left += kids.get(q, [])
        return found

    out = []
    for p, who in members.items():
        below = subtree(p)
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(who) if len(rebuilt[c]) == len(p))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(kids.get(p, [])),
                    sum(q not in kids for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def case(seed=1):
    rng, rows = random.Random(seed), []
    for conv in list(range(0, 40)) + list(range(100, 130)) + [205, 206, 310, 399, -100, -7, 2**62]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(["a", "bü", "ccc 中"])))
    rows += [(500, None, None, None), (500, 3, "user", None), (500, 3, "user", None), (500, 3, "assistant", "x" * 20000), (None, 0, "user", "lost")]
    # role and text do not run into each other
    rows += [(601, k, "r", "s") for k in range(6)] + [(602, k, "rs", "") for k in range(6)]
    rows += rows[:3]
    return rows


def got(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(table).collect()), key=repr)


def test_matches_brute_force(spark):
    rows = case()
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("segment", [2])
def test_segments_of_long_conversations(spark, monkeypatch, segment):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    monkeypatch.setattr(prefix_trie, "IDS_PER_STRING", 2)
    rows = case(2)
    assert got(spark, rows) == brute(rows)


def test_turn_numbers_far_apart(spark):
    rows = [(1, t, "user", str(t)) for t in (5000, -3, 1024, 1023, 2**40, -2**40, 0)] + [(1, None, "user", "none")]
    found = prefix_trie.ordered_turns(spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)).orderBy("place").collect()
    assert [r.text for r in found] == ["none", str(-2**40), "-3", "0", "1023", "1024", "5000", str(2**40)]
    assert [r.place for r in found] == list(range(1, 9))


def test_identical_conversations_form_one_weighted_sequence(spark):
    rows = [(100 * k, t, "user", f"t{t}") for k in range(300) for t in range(7)]
    found = got(spark, rows)
    assert found == brute(rows)
    assert len(found) == 8 and {r[3] for r in found} == {300}


def test_empty_table(spark):
    assert got(spark, []) == []
