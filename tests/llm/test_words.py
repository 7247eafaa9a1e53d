import numpy as np
import pyarrow as pa

from tidemark.llm import words


def test_chunks_use_the_bytes_of_a_batch_where_they_are():
    texts = pa.array(["ab" * 5000] * 1000)
    before, most = pa.total_allocated_bytes(), 0
    for _ in words.text_chunks(texts, 1 << 18):
        most = max(most, pa.total_allocated_bytes() - before)
    assert most < 1 << 20


def test_chunks_of_slices_nulls_and_wide_offsets():
    texts = ["skipped", "a", None, "", "\u00f1\u00f1", "b" * 9, None]
    for kind in (pa.string(), pa.large_string()):
        got = []
        for i, j, data, offsets in words.text_chunks(pa.array(texts, kind).slice(1), 4):
            assert offsets.dtype == np.int64 and len(offsets) == j - i + 1
            got += [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
        assert got == [t or "" for t in texts[1:]]
