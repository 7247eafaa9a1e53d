import random

import pytest


@pytest.fixture
def docs(spark):
    """docs(rows): documents from (doc_id, text[, source]) tuples, with an extra column whose name helpers like to use."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or ""), "x") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    return build


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n, vocabulary): n pseudo-words, the same for equal arguments."""
    def build(seed, n, vocabulary=400):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
    return build


ODD_TEXTS = [None, "", "   \n\t ", "one", "one two three", "Ünïcode wörds ñ 中文   end\x85x", "a" * 5000, "<|endoftext|> it's 'S #%"]


@pytest.fixture
def odd_texts():
    return ODD_TEXTS
