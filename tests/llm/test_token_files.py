import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_packing_is_exact(bits):
    ids = np.random.Generator(np.random.PCG64(bits)).integers(0, 2**bits, 1001, dtype=np.uint64).astype(np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert (token_files.unpack(data, 1001, bits) == ids).all()


def test_width_is_the_least():
    assert [token_files.width_of(n) for n in (1, 2, 3, 256, 257, 49408, 65537)] == [1, 1, 2, 8, 9, 16, 17]


def test_random_access(tmp_path):
    rng = np.random.Generator(np.random.PCG64(2))
    parts = [rng.integers(0, 5000, n) for n in (0, 1, 700, 64, 3, 1000)]
    uri = str(tmp_path / "x.tok")
    writer = token_files.Writer(uri, 13, 64)
    for k, p in enumerate(parts):
        writer.add(None if k == 1 else k, p.astype(np.uint32))
    writer.close()
    reader, whole = token_files.Reader(uri), np.concatenate(parts)
    assert reader.tokens == len(whole) and reader.nulls.tolist() == [False, True] + [False] * 4
    assert reader.starts.tolist() == np.cumsum([0, *map(len, parts)]).tolist()
    for a, b in ((0, 0), (0, 1), (63, 65), (128, 192), (700, len(whole)), (0, len(whole))):
        assert (reader.read(a, b) == whole[a:b]).all()


def test_encoder_equals_the_library(odd_texts, prose):
    texts = [t or "" for t in odd_texts] + [
        "it's a TEST, l'été. don't we're I'll x'd 'S", "<|ENDOFTEXT|> x", "a\x1cb c\x85d e", "１２ 3½ İSTANBUL ΣΑΣ ﬁ", "é ÀÉÿß×÷ é",
        "#%.,a1b22-+()'s''t'vex", prose(1, 500), "Hati*** bleea### 12%%"]
    encoder, library = token_files.Encoder(PATH, 2), Tokenizer.from_file(PATH)
    assert encoder.by_word
    for text in texts * 2:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == [*library.encode(text, add_special_tokens=False).ids, 2], text


def test_pieces_between_spaces_equal_the_library_and_are_remembered(monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 40)
    encoder, library = token_files.Encoder(PATH, 2), Tokenizer.from_file(PATH)
    rng = np.random.Generator(np.random.PCG64(3))
    for _ in range(300):
        text = "".join("ab É'''strevl.1 \t-ÿ×"[k] for k in rng.integers(0, 20, 40))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], text
    asked, tokenize = [], encoder.known.tokenize
    encoder.known.tokenize = lambda word: asked.append(word) or tokenize(word)
    for k in range(200):
        encoder.encode(f"harbour. wo{'x' * k}")
    # A common word is not encoded again when the memory is full.
    assert asked.count("harbour") == 1 and len(encoder.known) + len(encoder.known.older) <= 80


def test_other_tokenizers_go_through_the_library(odd_texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = token_files.Encoder(path, 50256), Tokenizer.from_file(path)
    assert not encoder.by_word
    for text in odd_texts:
        assert np.frombuffer(encoder.encode(text or ""), "<u4").tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 50256]


def test_files_read_back_in_order(docs, prose, odd_texts):
    rows = [(1000 - k, t) for k, t in enumerate(odd_texts)] + [(k, prose(k, 30 + k)) for k in range(50)]
    rows += [rows[9], (rows[9][0], "another text"), (None, "no id"), (None, None)]
    got = [tuple(r) for r in token_files.read_token_files(token_files.write_token_files(docs(rows), PATH, 2, block=64)).collect()]
    library, want = Tokenizer.from_file(PATH), []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    by_start = sorted(got, key=lambda r: r[1])
    assert sorted(((d, n, c) for d, _, n, c in got), key=repr) == sorted(want, key=repr)
    assert [r[1] for r in by_start] == np.cumsum([0, *[r[2] for r in by_start]])[:-1].tolist()
    assert [r[0] for r in by_start] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))


def test_empty_table(docs):
    assert token_files.read_token_files(token_files.write_token_files(docs([]), PATH, 2)).count() == 0
