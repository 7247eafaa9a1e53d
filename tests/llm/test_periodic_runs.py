import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import periodic_runs
from tidemark.llm.queries import run_digest


def brute_runs(w):
    """Each stretch that keeps a period, with its smallest one."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def changed(doc, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = None if doc is None else zlib.crc32(str(doc).encode())
    if h is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    return w


def brute(rows):
    out = []
    for doc, text in rows:
        w = changed(doc, text)
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        out.append((doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                    hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in run_digest(periodic_runs.periodic_runs(periodic_runs.with_repeated_tails(df))).collect()), key=repr)


def texts():
    rng, out = random.Random(3), []
    for k in range(400):
        out.append(" ".join(rng.choice("ab" if k % 2 else "abc") for _ in range(rng.randrange(60))))
    for k in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            unit = [f"w{rng.randrange(4)}" for _ in range(rng.randrange(1, 7))]
            parts += unit * rng.randrange(1, 8) + unit[:rng.randrange(len(unit))]
        out.append("\n ".join(parts))
    fib = ["a", "ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    out += [" ".join(fib[-1]), "a " * 3000, "a b " * 900, "a b a " * 700 + "c " * 50, " ".join(["abc", "ab"] * 3 + ["ab"] * 5) * 3]
    return out


def test_matches_brute_force(docs, odd_texts):
    rows = list(enumerate(odd_texts + texts())) + [(None, "x " * 9), (7, None), (7, "y z " * 9), (7, "y z " * 9), (-5, "q " * 6)]
    assert got(docs(rows)) == brute(rows)


def test_a_long_text_of_one_period():
    words = ["a", "b", "c"] * 60000
    ids = np.array([zlib.crc32(x.encode()) for x in words], np.uint64)
    found = periodic_runs._runs_of_chunk(periodic_runs.Hasher(), ids, np.array([0, len(words)]))
    assert found == {0: [(0, len(words), 3)]}


def test_many_left_words_before_a_short_repeat():
    # The node of "x x x x x" has as many left classes as occurrences.
    words = [x for k in range(5000) for x in (f"l{k}", *["x"] * 7)]
    ids = np.array([zlib.crc32(x.encode()) for x in words], np.uint64)
    found = periodic_runs._runs_of_chunk(periodic_runs.Hasher(), ids, np.array([0, len(words)]))[0]
    assert found == [(8 * k + 1, 7, 1) for k in range(5000)]


@pytest.mark.parametrize("seed", range(6))
def test_suffixes_are_in_order(seed):
    rng = np.random.Generator(np.random.PCG64(seed))
    words = rng.integers(0, 2 + seed % 2, 400).astype(np.uint64)
    first = np.array([0, 0, 100, 101, 250, 400])
    found = periodic_runs._sorted_suffixes(words, first)
    _, ids = np.unique(words, return_inverse=True)
    for a, b in zip(first[:-1], first[1:]):
        mine = [int(i) for i in found if a <= i < b]
        tuples = {i: tuple(ids[i:b]) for i in range(a, b)}
        assert mine == sorted(mine, key=tuples.get)
        for i in range(a, b - 3):
            if sum(t[:4] == tuples[i][:4] for t in tuples.values()) > 1:
                assert i in mine


def test_empty_table(docs):
    assert got(docs([])) == []
