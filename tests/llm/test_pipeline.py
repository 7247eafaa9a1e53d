import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.sources.durable import checkpoint


@pytest.fixture
def folder(spark, docs, prose, tmp_path):
    rows = [(k, prose(k, 40 + k % 60, 3000), f"src{k % 3}") for k in range(200)]
    rows += [(300 + k, " ".join(w + "###" for w in prose(500 + k, 60).split()), "src0") for k in range(60)]
    rows += [(400 + k, rows[k][1], "src1") for k in range(20)]
    item = prose(9999, 25, 3000)
    rows += [(500, f"{prose(77777, 40, 3000)} {item}", "src2")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, 1, 0) for k in range(0, 200, 2)] + [(300 + k, 0, 0) for k in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = checkpoint(stage(spark, docs, folder))
        assert docs.columns == columns
        ids[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids[name] <= {r.doc_id for r in before.select("doc_id").collect()}
    assert not any(300 <= k < 360 for k in ids["quality"]) and len(ids["quality"] & set(range(200))) >= 195
    assert not any(400 <= k < 420 for k in ids["near_duplicates"] if k - 400 in ids["quality"])
    assert len(ids["near_duplicates"] & set(range(200))) >= 190
    assert 500 in ids["quality"] and 500 not in ids["decontamination"]
    last = sorted(map(tuple, corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()), key=lambda r: r[1])
    library, want = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER)), []
    for r in docs.collect():
        own = library.encode(r.text, add_special_tokens=False).ids + [corpus_pipeline.END_ID]
        want.append((r.doc_id, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert sorted((d, n, c) for d, _, n, c in last) == sorted(want)


def test_run_chains_all_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 150


def test_stages_take_empty_tables(spark, docs, folder):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs([]), folder).count() == 0, name


def test_stages_take_odd_rows(spark, docs, folder, odd_texts):
    rows = [(k, t, None if k % 2 else "s") for k, t in enumerate(odd_texts)] + [(None, "a b c", None), (3, "one", "s"), (3, "one", "s")]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs(rows), folder).count() >= 1, name


def test_mixture_keeps_words_in_order(spark, docs, folder, prose):
    rows = [(k, prose(k, 150, 3000), f"s{k % 4}") for k in range(30)]
    texts = dict((r[0], r[1].split()) for r in rows)
    for r in corpus_pipeline.mixture(spark, docs(rows), folder).collect():
        rest = iter(texts[r.doc_id])
        assert all(w in rest for w in re.split(r"\s+", r.text))
