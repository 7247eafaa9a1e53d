import hashlib
import random
import re

from tidemark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(rows, items, window=10):
    windows = []
    for item, text in items:
        w = words(text)
        windows += [("" if item is None else str(item), tuple(w[i:i + window])) for i in range(max(1, len(w) - window + 1)) if w]
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for item, run in windows:
            for i in range(len(w) - len(run) + 1):
                if tuple(w[i:i + len(run)]) == run:
                    hit |= set(range(i, i + len(run)))
                    found.add(item)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def case(odd_texts):
    rng = random.Random(3)
    vocabulary = ["the", "of", "a"] + [f"w{k}" for k in range(12)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.choice([1, 2, 3, 9, 10, 11, 30]))) for k in range(14)] + [(5, say(15)), (None, say(12)), (90, None), (91, "")]
    rows = [(k, t) for k, t in enumerate(odd_texts)]
    for k in range(60):
        text = say(rng.randrange(1, 60))
        if k % 3 == 0:
            text += f", {(rng.choice(items)[1] or '').upper()}. {say(5)}\n{rng.choice(items)[1]}!"
        rows.append((100 + k, text))
    rows += [rows[20], rows[20], (None, rows[30][1])]
    return rows, items


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_matches_brute_force(spark, docs, odd_texts):
    rows, items = case(odd_texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(decontaminate.contamination(docs(rows), bench)) == brute(rows, items)


def test_blocks_of_the_benchmark_give_the_same(spark, docs, odd_texts):
    rows, items = case(odd_texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(decontaminate.contamination(docs(rows), bench, block_words=60)) == brute(rows, items)
    clean = sorted(r[0] for r in brute(rows, items) if not r[5] and r[0] is not None)
    kept = decontaminate.clean_documents(docs(rows), bench, block_words=60)
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == clean


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert got(decontaminate.contamination(docs([(1, "a b c")]), bench))[0][1:4] == (3, 0, 0)
    assert decontaminate.contamination(docs([]), bench).count() == 0


def test_containment_allows_substitutions(spark, docs):
    item = "a b c d e f g h i j k l"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    changed = "x " + item.replace("l", "z") + " y"
    rows = [(1, changed), (2, "a b c q e f r h i s k l")]
    found = decontaminate.benchmark_hits(docs(rows), bench, window=12, containment=0.8)
    assert {r.doc_id: len(r.hits) for r in found.collect()} == {1: 12, 2: 0}
