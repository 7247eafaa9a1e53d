import hashlib
import re

from tidemark.llm import substrings


def brute(rows, window):
    texts = [(doc, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc, text in rows]
    order = lambda doc: float("inf") if doc is None else doc
    first = {}
    for doc, w in texts:
        for i in range(len(w) - window + 1):
            run = tuple(w[i:i + window])
            first[run] = min(first.get(run, float("inf")), order(doc))
    out = []
    for doc, w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < order(doc):
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.drop("spans", "factors").collect()), key=repr)


def case(prose, odd_texts):
    rows = list(enumerate(odd_texts))
    shared = [prose(900 + k, 50 + 7 * k).split() for k in range(4)]
    for k in range(40):
        own = prose(k, 120, 5000).split()
        for s in range(k % 3):
            at = (17 * k + 40 * s) % 110
            own[at:at] = shared[(k + s) % 4]
        rows.append((1000 - 7 * k, " ".join(own)))
    rows += [(5000, " ".join(["Same"] * 300)), (5001, "x " + " ".join(["Same"] * 120)), (5002, "one two " * 90), (4999, "two one " * 40)]
    rows += [(2000 + k, rows[20][1]) for k in range(5)] + [(2000, rows[20][1]), (2001, rows[21][1]), (None, rows[22][1]), (None, rows[22][1])]
    # Half a passage of one text beside half of another: no window is shared across the seam.
    rows.append((9000, " ".join(shared[0][:49] + shared[1][-49:])))
    return rows


def test_matches_brute_force(docs, prose, odd_texts):
    rows = case(prose, odd_texts)
    assert got(substrings.substring_dedup(docs(rows))) == brute(rows, 50)


def test_other_window_lengths(docs, prose, odd_texts):
    rows = case(prose, odd_texts)
    assert got(substrings.substring_dedup(docs(rows), window=12, anchor=5)) == brute(rows, 12)


def test_spans_are_the_removed_words(docs, prose):
    text = prose(1, 80)
    rows = [(1, text), (2, f"a b {text} c d")]
    found = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in substrings.substring_dedup(docs(rows)).collect()}
    assert found == {1: [], 2: [(2, 82)]}


def test_empty_table(docs):
    assert substrings.substring_dedup(docs([])).count() == 0


def test_the_largest_id_is_an_id(docs, prose):
    text = prose(1, 80)
    rows = [(2**63 - 1, text), (2**63 - 1, "a b"), (None, text), (None, None), (7, text)]
    found = {(r.doc_id, r.n_words): r.n_removed for r in substrings.substring_dedup(docs(rows)).collect()}
    assert found == {(2**63 - 1, 80): 80, (2**63 - 1, 2): 0, (None, 80): 80, (None, 0): 0, (7, 80): 0}


def brute_factors(texts, window):
    """Greedy parse of each text against all texts of smaller ids: (start, end, ref, ref_start), longest first."""
    out = {}
    for doc, words in texts.items():
        out[doc], at = [], 0
        while at < len(words):
            best = (0, 0, 0)
            for other in sorted(k for k in texts if k < doc):
                theirs = texts[other]
                for i in [i for i, w in enumerate(theirs) if w == words[at]]:
                    n = 0
                    while i + n < len(theirs) and at + n < len(words) and theirs[i + n] == words[at + n]:
                        n += 1
                    best = max(best, (n, -other, -i))
            if best[0] >= window:
                out[doc].append((at, at + best[0], -best[1], -best[2]))
                at += best[0]
            else:
                at += 1
    return out


def test_factors_equal_a_brute_force_parse(docs, prose):
    own = {k: prose(k, 400, 10**6).split() for k in range(6)}
    texts = dict(own)
    # Passages beside each other, long ones over many blocks, whole texts, ones below the window.
    texts[10] = own[1][20:90] + own[2][100:340] + ["x"] + own[3][5:54] + own[0]
    texts[11] = prose(20, 30, 10**6).split() + own[5][350:] + own[4][:75] + ["y", "z"] + own[4][75:124] + own[4][200:300]
    texts[12] = own[3][:399]
    texts[13] = ["a"] + own[0][:50] + own[0][:51] + own[0][349:] + ["b"]
    rows = [(k, " ".join(w)) for k, w in texts.items()]
    found = {r.doc_id: [(f.start, f.end, f.ref, f.ref_start) for f in r.factors] for r in substrings.substring_dedup(docs(rows)).collect()}
    assert found == brute_factors(texts, 50)
    assert len(found[10]) == 3 and len(found[11]) == 3 and len(found[13]) == 3


def test_factors_hold_what_they_name(docs, prose, odd_texts):
    rows = [r for r in case(prose, odd_texts) if r[0] is not None]
    texts = {}
    for doc, text in rows:
        texts.setdefault(doc, []).append(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    for r in substrings.substring_dedup(docs(rows), window=12, anchor=5).collect():
        own, covered, end = [t for t in texts[r.doc_id] if len(t) == r.n_words], set(), 0
        for f in r.factors:
            assert f.ref < r.doc_id and f.start >= end and f.end - f.start + f.back >= 12
            end = f.end
            covered |= set(range(f.start - f.back, f.end))
            theirs = [t[f.ref_start - f.back:f.ref_start + f.end - f.start] for t in texts[f.ref]]
            assert any(t[f.start - f.back:f.end] in theirs for t in own)
        assert covered == {w for s in r.spans for w in range(s.start, s.end)}
        assert not any(a.ref == b.ref and a.end == b.start and a.ref_start + a.end - a.start == b.ref_start for a, b in zip(r.factors, r.factors[1:]))


def test_a_factor_that_only_the_words_before_its_boundary_make_long_enough(docs, prose):
    words = prose(3, 200, 10**6).split()
    rows = [(1, " ".join(words[:80] + ["p"])), (2, " ".join(["q"] + words[60:120])), (3, " ".join(["r"] + words[:120] + ["s"]))]
    row = {r.doc_id: r for r in substrings.substring_dedup(docs(rows)).collect()}[3]
    assert [tuple(f) for f in row.factors] == [(1, 81, 1, 0, 0), (81, 121, 2, 21, 20)]
    assert [tuple(s) for s in row.spans] == [(1, 121)]
