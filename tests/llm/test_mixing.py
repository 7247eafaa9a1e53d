import re

from pyspark.sql import functions as F

from tidemark.llm import mixing


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    t = {s: share * sum(sizes.values()) * w[s] / sum(w.values()) for s in names}
    while any(t[s] > most * sizes[s] + 1e-9 for s in names):
        excess = sum(max(0, t[s] - most * sizes[s]) for s in names)
        t = {s: min(t[s], most * sizes[s]) for s in names}
        free = [s for s in names if t[s] < most * sizes[s] - 1e-9]
        for s in free:
            t[s] += excess * w[s] / sum(w[x] for x in free)
    return t


def case(prose, odd_texts):
    rows = [(k, t, ["a", "b", None][k % 3]) for k, t in enumerate(odd_texts)]
    rows += [(100 + k, prose(k, 20 + 13 * k), "hot" if k % 2 else ["a", "ä", "B", None][k // 2 % 4]) for k in range(60)]
    return rows + [rows[-1], rows[-1], (None, prose(3, 300), "a"), (None, prose(3, 300), "a"), (7777, None, "void")]


def test_targets_sizes_and_limits(docs, prose, odd_texts):
    rows = case(prose, odd_texts)
    got = mixing.taken_words(docs(rows)).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r[0]), count(r[1])) for r in rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + count(text)
    want = targets(sizes)
    for source, size in sizes.items():
        ids = {str(r[0]) for r in rows if r[2] == source}
        own = [r for r in got if str(r.doc_id) in ids and r.source_size == size]
        assert all(abs(r.target - want[source]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - want[source]) <= 1.5 * max(1, min(mixing.BLOCK, size // mixing.LEAST_BLOCKS))  # half a block, and a last block that is not full
    assert all(r.taken <= 2 * r.size for r in got)


def test_many_small_sources_come_near_their_targets(docs, prose):
    rows = [(k, prose(k, 30), f"s{k:02d}") for k in range(60)]
    got = {r.doc_id: r for r in mixing.taken_words(docs(rows)).collect()}
    assert all(abs(r.taken - r.target) <= 1.5 and r.taken > 0 for r in got.values()) and len({r.target for r in got.values()}) > 1


def test_reruns_agree(docs, prose, odd_texts):
    rows = case(prose, odd_texts)
    once = sorted(map(repr, mixing.taken_words(docs(rows)).collect()))
    assert once == sorted(map(repr, mixing.taken_words(docs(rows[::-1]).repartition(7)).collect()))


def test_permutations_are_permutations(spark):
    for n in (1, 2, 3, 7, 50, 101, 1000):
        out = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(3))).collect()
        assert sorted(r[0] for r in out) == list(range(n))


def test_mixed_documents_hold_the_taken_words(docs, prose, odd_texts):
    rows = case(prose, odd_texts)
    mixed = mixing.mixed_documents(docs(rows))
    assert mixed.columns == docs(rows).columns
    words = {}
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    taken = {}
    for r in mixing.taken_words(docs(rows)).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    # The digest of the whole row is the key in both, so both draw the same mix.
    assert words == {k: v for k, v in taken.items() if v}


def test_no_python_in_the_plan(docs, prose):
    plan = mixing.taken_words(docs([(1, prose(1, 50))]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(docs):
    assert mixing.taken_words(docs([])).count() == 0
    assert mixing.mixed_documents(docs([])).count() == 0


def test_shards_hold_the_mix_in_multinomial_counts(spark, docs, prose, odd_texts, tmp_path):
    rows = case(prose, odd_texts) + [(9000 + k, prose(900 + k, 2000), "hot" if k % 2 else "a") for k in range(20)]
    how = {"block": 8, "shard_slots": 400}
    path = str(tmp_path / "shards")
    mixing.write_shards(docs(rows), path, **how)
    stored = spark.read.parquet(path)
    counts = mixing.shard_counts(mixing.mix_sources(docs(rows), **how)).collect()
    n_words = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    got = {(r.shard, r.source): (r.a, r.b) for r in stored.groupBy("shard", "source").agg(F.count("*").alias("a"), F.sum(n_words).alias("b")).collect()}
    assert got == {(r.shard, r.source): (r.n_slots, r.n_words) for r in counts}
    assert sum(b for _, b in got.values()) == sum(r.taken for r in mixing.taken_words(docs(rows), **how).collect())

    # Each slot falls into a shard by itself: the counts of a large source spread as multinomial draws do, neither evenly nor more.
    shards = 1 + max(r.shard for r in counts)
    assert shards > 10
    for source in ("hot", "a"):
        n = [got.get((k, source), (0, 0))[0] for k in range(shards)]
        mean = sum(n) / shards
        spread = sum((x - mean) ** 2 for x in n) / mean
        assert abs(spread - (shards - 1)) < 4 * (2 * (shards - 1)) ** 0.5 and spread > 1

    # A block is made of runs of words of its source's texts.
    texts = {}
    for _, text, source in rows:
        texts[source] = texts.get(source, "") + " | " + " ".join((text or "").split())
    for r in stored.filter("source = 'hot'").limit(200).collect():
        own = r.text.split()
        seams = sum(f"{a} {b}" not in texts["hot"] for a, b in zip(own, own[1:]))
        assert len(own) <= 8 and seams <= 2
    # Files are ordered by place.
    for f in stored.inputFiles()[:3]:
        places = [r.place for r in spark.read.parquet(f).select("place").collect()]
        assert places == sorted(places)


def test_shards_of_an_empty_table(docs):
    assert mixing.shard_blocks(docs([])).count() == 0
