"""Token ids in fixed-width bit-packed files.

Each id takes the fewest bits that hold the vocabulary. A file is

    magic "TKPK", version u8, bits u8, block u32
    ids, packed in blocks of ``block`` ids; each block starts on a byte
    doc_id i64 and null flag u8 of each document, token start u64 of each document and the end
    byte offset u64 of each block and the end
    documents u64, tokens u64, byte position u64 of these tables

All numbers are little-endian, bits go from the lowest up. A reader finds any
token through the block offsets and unpacks whole blocks with numpy.

Writing: documents are dealt by ranges of doc_id, encoded, and written one file per
range in ascending order (a null doc_id comes first, equal ids are ordered by a hash of the
text, then by the text). Tasks stream; no file is ever held. Starts come from per-file totals.

Nulls: a null text is empty and has the end id alone.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import files
from tidemark.sources.durable import checkpoint, scratch_path

MAGIC, VERSION = b"TKPK", 1
HEAD = "<4sBBI"
BLOCK = 4096
KNOWN_WORDS = 200_000
FILE_BYTES = 256 << 20


def width_of(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, padded to a byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    spread = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (spread.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


# Characters whose words the encoder finds itself: ASCII but for controls, and the letters of Latin-1. They
# are composed, so normalisation only lowers them.
_PLAIN = re.compile(r"[\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
# Fixed value: the pre-tokenizer's pattern, for lowered text of those characters; the commonest words are tried first.
_WORDS = re.compile(r"[a-zß-öø-ÿ]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\t-\r\x20a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a letter: itself if it is printable in Latin-1, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    letters = {b: chr(b) for b in printable} | {b: chr(0x100 + k) for k, b in enumerate(others)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in (*range(0x21, 0x7F), *range(0xC0, 0x100))}


class Pieces(dict):
    """Ids, four bytes each, of what stands between white space in lowered plain text.

    No word of the pre-tokenizer goes across white space. Ids are remembered for the last ``limit`` pieces at least and twice as
    many at most; the library's model encodes each word of the others.
    """

    def __init__(self, model, limit: int):
        self.tokenize, self.limit = model.tokenize, limit
        self.letters = _byte_letters()
        self.older: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        found = [t.id for t in self.tokenize(word if word.isascii() else word.translate(self.letters))]
        return struct.pack(f"<{len(found)}I", *found)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            if piece.isalpha():
                ids = self._word(piece)
            elif piece[:-1].isalpha():
                # One sign or digit behind letters is a word of its own.
                ids = self[piece[:-1]] + self[piece[-1]]
            else:
                words = _WORDS.findall(piece)
                ids = self._word(piece) if len(words) == 1 else b"".join(map(self.__getitem__, words))
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Ids of whole texts by the tokenizers library.

    For a lower-casing word tokenizer, the words of a plain text are found here and
    the library's model encodes each of them, once as long as it is remembered. Other
    texts, and all texts of tokenizers of another make, go through the library whole.
    """

    def __init__(self, path: str, end_id: int, by_word: bool | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.uint32(end_id).tobytes()
        self.known = Pieces(self.tokenizer.model, KNOWN_WORDS)
        self.by_word = is_word_tokenizer(path) if by_word is None else by_word

    def encode(self, text: str) -> bytes:
        """The ids of the text and the end id, four bytes each."""
        if not (self.by_word and _PLAIN.fullmatch(text) and "<|" not in text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + self.end
        return b"".join(map(self.known.__getitem__, text.lower().split())) + self.end


def is_word_tokenizer(path: str) -> bool:
    """Whether the tokenizer lowers texts and parts them into words as ``_WORDS`` does."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    steps = [n.get("type") for n in (parts.get("normalizer") or {}).get("normalizers", [])]
    split = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    pattern = (split[0].get("pattern") or {}).get("Regex", "")
    special = [t["content"] for t in parts.get("added_tokens", [])]
    return (
        steps == ["NFC", "Replace", "Lowercase"] and [p.get("type") for p in split] == ["Split", "ByteLevel"]
        and pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" and all(t.startswith("<|") for t in special))


class Writer:
    """One file, written as ids come; a block is held at most."""

    def __init__(self, uri: str, bits: int, block: int):
        self.out, self.bits, self.block = files.open_output(uri), bits, block
        self.docs, self.starts, self.offsets, self.tokens = [], [], [], 0
        self.at, self.rest = struct.calcsize(HEAD), np.zeros(0, np.uint32)
        self.out.write(struct.pack(HEAD, MAGIC, VERSION, bits, block))

    def _flush(self, least: int) -> None:
        while len(self.rest) >= least and len(self.rest):
            data = pack(self.rest[:self.block], self.bits)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
            self.rest = self.rest[self.block:]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.tokens)
        self.tokens += len(ids)
        self.rest = np.concatenate([self.rest, ids])
        self._flush(self.block)

    def close(self) -> None:
        self._flush(1)
        self.out.write(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        self.out.write(np.array([d is None for d in self.docs], "<u1").tobytes())
        self.out.write(np.array([*self.starts, self.tokens], "<u8").tobytes())
        self.out.write(np.array([*self.offsets, self.at], "<u8").tobytes())
        self.out.write(struct.pack("<QQQ", len(self.docs), self.tokens, self.at))
        self.out.close()


class Reader:
    """Random access to one file."""

    def __init__(self, uri: str):
        self.file = files.open_input(uri)
        magic, version, self.bits, self.block = struct.unpack(HEAD, self._at(0, struct.calcsize(HEAD)))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{uri} is not a token file")
        n, self.tokens, tables = struct.unpack("<QQQ", self._at(self.file.size() - 24, 24))
        data = self._at(tables, self.file.size() - 24 - tables)
        self.doc_ids = np.frombuffer(data, "<i8", n)
        self.nulls = np.frombuffer(data, "<u1", n, 8 * n).astype(bool)
        self.starts = np.frombuffer(data, "<u8", n + 1, 9 * n).astype(np.int64)
        self.offsets = np.frombuffer(data, "<u8", -1, 17 * n + 8).astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset)

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end) of the file."""
        if end <= start:
            return np.zeros(0, "<u4")
        low, high = start // self.block, -(-end // self.block)
        data, base, out = self._at(int(self.offsets[low]), int(self.offsets[high] - self.offsets[low])), self.offsets[low], []
        for b in range(low, high):
            n = min(self.block, self.tokens - b * self.block)
            out.append(unpack(data[self.offsets[b] - base:self.offsets[b + 1] - base], n, self.bits))
        return np.concatenate(out)[start - low * self.block:end - low * self.block]

    def close(self) -> None:
        self.file.close()


@dataclass
class TokenFiles:
    """Where the ids are: one row per file with path, part, documents, tokens and start (ids of all files before)."""

    manifest: DataFrame


def write_token_files(
    documents: DataFrame, tokenizer: str, end_id: int, vocabulary: int | None = None, folder: str | None = None,
    block: int = BLOCK, file_bytes: int = FILE_BYTES,
) -> TokenFiles:
    """Encodes every text, appends ``end_id`` and writes all ids in ascending doc_id order."""
    spark = documents.sparkSession
    if vocabulary is None:
        vocabulary = _vocabulary(tokenizer)
    bits, by_word = width_of(max(vocabulary, end_id + 1)), is_word_tokenizer(tokenizer)
    folder = files.folder_uri(folder or scratch_path(spark, "tokens"))
    files.make_folder(folder)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // file_bytes))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer, part, encoder = None, TaskContext.get().partitionId(), None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for doc, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    if writer is None:
                        path, encoder = files.fresh_name(folder, "tok"), Encoder(tokenizer, end_id, by_word)
                        writer = Writer(path, bits, block)
                    writer.add(doc, np.frombuffer(encoder.encode(text), "<u4"))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "documents": [len(writer.docs)], "tokens": [writer.tokens]},
                                             pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())]))

    # The hash parts rows of one id; boundaries are sampled from these two columns alone.
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash")]
    ranged = docs.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    written = checkpoint(ranged.mapInArrow(write, "part int, path string, documents bigint, tokens bigint"))
    # One row per file: the running total is over files, not over documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return TokenFiles(checkpoint(written.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("bigint")))))


def _vocabulary(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).get_vocab_size()


def read_token_files(stored: TokenFiles, step: int = 1 << 20) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files; about ``step`` ids are held at a time."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = Reader(path)
                at, n = 0, len(reader.doc_ids)
                while at < n:
                    to = max(at + 1, int(np.searchsorted(reader.starts, reader.starts[at] + step, "right")) - 1)
                    first = int(reader.starts[at])
                    data = memoryview(reader.read(first, int(reader.starts[to])).tobytes())
                    cuts = ((reader.starts[at:to + 1] - first) * 4).tolist()
                    crcs = [zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(reader.doc_ids[at:to], mask=reader.nulls[at:to]), pa.array(reader.starts[at:to] + start),
                        pa.array(np.diff(reader.starts[at:to + 1])), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                    at = to
                reader.close()

    paths = files.task_each(stored.manifest.select("path", "start"))
    return paths.mapInArrow(scan, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
