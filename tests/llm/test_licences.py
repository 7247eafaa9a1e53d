import re
from collections import Counter

import pytest

from tidemark.llm import licences
from tidemark.llm.licence_texts import TEMPLATES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bigrams(words):
    return Counter(zip(words, words[1:]))


def brute(text, least):
    known = [(k, name, bigrams(WORD.findall(t.translate(LOW)))) for k, (name, t) in enumerate(TEMPLATES)]
    words = WORD.findall((text or "").translate(LOW))
    pairs = list(zip(words, words[1:]))
    found = []
    for number, name, other in known:
        total = sum(other.values())
        if 2 * sum((bigrams(words) & other).values()) < least * total:
            continue
        for i in range(len(pairs)):
            own, shared = Counter(), 0
            for j in range(i, len(pairs)):
                if 2 * total < least * (j - i + 1 + total):
                    break
                own[pairs[j]] += 1
                shared += own[pairs[j]] <= other[pairs[j]]
                dice = 2 * shared / (j - i + 1 + total)
                if dice >= least:
                    found.append((-dice, -total, i, j + 2, number, name))
    out, taken = [], []
    for dice, _, first, end, number, name in sorted(found):
        if all(end <= a or first >= b for a, b in taken):
            taken.append((first, end))
            out.append((first, end, number, name, round(-dice, 9)))
    return sorted(out)


def found_in(df):
    return {r.doc_id: [(m.first_word, m.end_word, m.template, m.licence, round(m.dice, 9)) for m in r.matches] for r in df.collect()}


def test_matches_all_templates_without_pruning(docs, prose, odd_texts):
    texts = [t for t in odd_texts if len(t or "") < 3000] + ["mit", "\n\n\n"]
    for k, (_, text) in enumerate(TEMPLATES):
        texts.append(f"{prose(k, 30)}\n\n{text.replace('. ', '.\n')}\n{prose(k + 50, 20)}")
        words = text.split()
        texts.append(f"intro {' '.join(w for i, w in enumerate(words) if i % 11)} {prose(k, 5)} {TEMPLATES[k - 1][1]}")
        texts.append(" ".join([text] * 2 + words[len(words) // 3:]))
    for least in (0.8, 0.6):
        got = found_in(licences.scan_licences(docs(list(enumerate(texts))), least=least))
        for k, text in enumerate(texts):
            assert got[k] == brute(text, least), (least, text)
    assert sum(bool(brute(t, 0.8)) for t in texts) >= 2 * len(TEMPLATES)


def test_texts_inside_long_lines(docs, prose):
    mit = TEMPLATES[0][1]
    rows = [
        (1, f"{prose(1, 400)} {mit} {prose(2, 400)}"),
        (2, "This page is Released under the MIT License. by us, as each page here and there"),
        (3, f"a\nb {mit} c\nd"),
        (4, " ".join(f"{prose(k, 40)} Licensed under CC BY 4.0." for k in range(500))),
    ]
    got = {r.doc_id: r.matches for r in licences.scan_licences(docs(rows)).collect()}
    assert [(m.licence, m.dice, m.first_word) for m in got[1]] == [("MIT", 1.0, 400)]
    assert [(m.licence, m.dice, m.first_word, m.end_word) for m in got[2]] == [("MIT", 1.0, 3, 8)]
    assert [(m.first_line, m.last_line) for m in got[3]] == [(1, 1)]
    assert [m.licence for m in got[4]] == ["CC-BY-4.0"] * 500


def test_templates_from_files(spark, docs, prose, tmp_path):
    own = prose(7, 3000)
    (tmp_path / "House-1.0.txt").write_text(own)
    templates = licences.read_templates(spark, str(tmp_path))
    assert templates == [("House-1.0", own)]
    words = own.split()
    rows = [(1, f"{prose(1, 300)} {' '.join(w for i, w in enumerate(words) if i % 40)} {prose(2, 300)}"), (2, prose(8, 3000))]
    found = {r.doc_id: [m.licence for m in r.matches] for r in licences.scan_licences(docs(rows), [*templates, ("Empty", "")]).collect()}
    assert found == {1: ["House-1.0"], 2: []}
    with pytest.raises(ValueError, match="at most"):
        licences.read_templates(spark, str(tmp_path), most=100)


def test_empty_table_repeated_rows_and_no_templates(docs):
    assert licences.scan_licences(docs([])).count() == 0
    line = "Released under the MIT License."
    assert [len(r.matches) for r in licences.scan_licences(docs([(1, line), (1, line), (None, line)])).collect()] == [1, 1, 1]
    assert [len(r.matches) for r in licences.scan_licences(docs([(1, line)]), templates=[]).collect()] == [0]
