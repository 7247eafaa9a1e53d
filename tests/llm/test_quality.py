import random

import numpy as np

from tidemark.llm import quality_model, quality_rules


def rated(prose, n=240):
    """Rows and labels: junk by symbols or repetition, toxic by a word, good otherwise."""
    rng, rows, labels = random.Random(2), [], []
    for k in range(n):
        text, kind = prose(k, rng.randrange(30, 120), 3000), k % 6
        if kind == 0:
            text = " ".join(w + "###" for w in text.split())
        elif kind == 1:
            text = " ".join(w for w in text.split()[:12] for _ in range(7))
        elif kind == 2:
            words = text.split()
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "Vile,"]))
            text = " ".join(words)
        rows.append((k, text))
        labels.append((k, int(kind > 1), int(kind == 2)))
    return rows, labels


def frame_of(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, docs, prose):
    rows, labels = rated(prose, 720)
    model = quality_model.fit_quality(docs(rows[:480]), frame_of(spark, labels))
    got = {r.doc_id: r for r in quality_model.score_quality(docs(rows[480:]).select("doc_id", "text"), model).collect()}
    right = [got[d].kept == (q == 1 and t == 0) for d, q, t in labels[480:]]
    assert np.mean(right) > 0.95
    grades = {d: 0 if q == 0 else 1 if t else 2 for d, q, t in labels[480:]}
    means = [np.mean([got[d].expected_grade for d, g in grades.items() if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]


def test_fit_is_the_same_again(spark, docs, prose):
    rows, labels = rated(prose)
    a = quality_model.fit_quality(docs(rows), frame_of(spark, labels))
    b = quality_model.fit_quality(docs(rows[::-1]).repartition(5), frame_of(spark, labels[::-1]))
    assert (a.features == b.features).all() and np.allclose(a.weights, b.weights, atol=1e-12) and a.cut == b.cut


def test_gradient_fits_a_known_model():
    rng = np.random.Generator(np.random.PCG64(4))
    x = rng.random((4000, 5)) < 0.5
    score = x @ np.array([2.0, -2.0, 1.0, 0.0, 0.0]) + rng.logistic(size=4000)
    grade = (score > -0.5).astype(int) + (score > 1.0)
    row, column = np.nonzero(x)
    weights, thresholds = quality_model.fit_ordinal(row, column, grade, 5, rounds=600, rate=0.05, prior=0, faults_only=False)
    assert np.abs(weights - [2, -2, 1, 0, 0]).max() < 0.25 and np.abs(thresholds - [-0.5, 1.0]).max() < 0.25


def test_missing_labels_keep_everything(spark, docs, prose, odd_texts):
    rows = list(enumerate(odd_texts))
    for labels in ([], [(0, 1, 0)], [(None, 1, 0), (1, None, 0), (2, 1, None)]):
        model = quality_model.fit_quality(docs(rows), frame_of(spark, labels))
        kept = quality_model.good_documents(docs(rows), model)
        assert kept.columns == docs(rows).columns and kept.count() == len(rows)
    assert quality_model.good_documents(docs([]), model).count() == 0


def test_odd_texts_are_scored(spark, docs, prose, odd_texts):
    rows, labels = rated(prose)
    model = quality_model.fit_quality(docs(rows), frame_of(spark, labels + labels[:3]))
    scored = quality_model.score_quality(docs(list(enumerate(odd_texts))).select("doc_id", "text"), model).collect()
    assert len(scored) == len(odd_texts) and all(0 <= r.tail_prob <= 1 and 0 <= r.expected_grade <= 2 for r in scored)


def brute_repeats(text, window=8):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    runs = [tuple(words[i:i + window]) for i in range(len(words) - window + 1)]
    hit = {p for i, r in enumerate(runs) if runs.count(r) > 1 for p in range(i, i + window)}
    return len(hit)


def test_base_measures(docs, prose, odd_texts):
    texts = odd_texts + ["a b c d e f g h " * 3, "x " * 100, prose(1, 60) + " " + prose(1, 20), prose(2, 40), "l1 w\nl1 w\n\n \nl1 w\nz", "# $ a*b <p>|&%"]
    got = {r.doc_id: r for r in quality_rules.base_measures(docs(list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), brute_repeats(text))
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text


def test_thresholds_adapt_to_source_and_language(docs, prose):
    # In one source five symbols per word are usual, in the other none.
    rows = [(k, prose(k, 60), "plain") for k in range(60)] + [(100 + k, " ".join(w + "###" for w in prose(k, 60).split()), "marked") for k in range(60)]
    rows += [(500, " ".join(w + "###" for w in prose(7, 60).split()), "plain"), (501, prose(8, 60), "rare"), (502, None, None), (503, prose(9, 60), None)]
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs(rows)).collect()}
    assert all(kept[k] for k in range(60)) and all(kept[100 + k] for k in range(60))
    assert not kept[500] and kept[501] and not kept[502] and kept[503]


def test_sketches_merge(docs, prose):
    measured = quality_rules.base_measures(docs([(k, prose(k, 10 + k)) for k in range(80)]))
    for name, value in quality_rules._measures().items():
        measured = measured.withColumn(name, value)
    count = lambda df: sorted(map(repr, df.collect()))
    halves = quality_rules.sketches(measured.filter("doc_id < 30")).unionByName(quality_rules.sketches(measured.filter("doc_id >= 30")))
    merged = halves.groupBy("lang", "source", "measure", "bucket").sum("n").withColumnRenamed("sum(n)", "n")
    assert count(merged) == count(quality_rules.sketches(measured))


def test_rules_run_without_python_and_on_empty_tables(docs, prose):
    assert quality_rules.quality_rules(docs([])).count() == 0
    plan = quality_rules.quality_rules(docs([(1, prose(1, 50))]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
