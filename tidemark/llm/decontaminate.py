"""Benchmark decontamination: a prefix-filtered join of benchmark windows with documents.

A benchmark item is cut into windows of ``window`` consecutive words (an item
with fewer words, but not none, is one window). A window is a set of shingles;
a document holds it where at least ``containment`` of them stand at their places.
By the prefix-filter principle, of a window's n shingles in ascending order of
their corpus frequency, one of the first ``n - required + 1`` must occur. So

1. one scan counts the benchmark's shingles over all documents (rarity order),
2. a second scan looks only those prefix shingles up. The shingle's place in the
   window fixes where the window would start (positional bound) and whether it
   fits into the document (length bound); what is left is verified word by word.

The benchmark is taken in blocks of at most ``block_words`` words (a longer item
is a block of its own), so what a task holds is bounded however large the
benchmark is; each block scans the documents, and hits are merged per document.

Nulls: a null or empty text has no words and no hits. A null item id counts as
the item named by the empty string. Rows that repeat give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import neutral, restored
from tidemark.llm.shared import by_value
from tidemark.llm.words import ALNUM_WORD, LOWER, Hasher, find_words, run_starts, text_chunks
from tidemark.sources.durable import checkpoint

WINDOW = 10
SHINGLE = 3
BLOCK_WORDS = 500_000
_FILTER_BITS = 20

FOUND = "n_words bigint, hits array<int>, items array<string>"


@dataclass
class Block:
    """Windows of some items: word hashes of all items, and per window its item, first word and length."""

    hashes: np.ndarray
    names: list[str]
    item: np.ndarray
    start: np.ndarray
    length: np.ndarray


def _words_of(column: pa.Array, hasher: Hasher) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for i, j, data, offsets in text_chunks(column):
        lowered = LOWER[data]
        starts, ends, first = find_words(lowered, offsets, ALNUM_WORD)
        yield i, j, hasher.words(lowered, starts, ends), first


def make_block(items: pa.Table, window: int) -> Block:
    hasher, hashes, names, item, start, length, at = Hasher(), [], [], [], [], [], 0
    ids = ["" if v is None else str(v) for v in items["item_id"].to_pylist()]
    for batch_at, text in zip(np.cumsum([0, *map(len, items["text"].chunks)]), items["text"].chunks):
        for i, j, found, first in _words_of(text, hasher):
            hashes.append(found)
            for k in range(i, j):
                n = int(first[k - i + 1] - first[k - i])
                if n:
                    begin = at + int(first[k - i]) + np.arange(max(1, n - window + 1))
                    start.append(begin)
                    length.append(np.full(len(begin), min(n, window)))
                    item.append(np.full(len(begin), len(names)))
                names.append(ids[int(batch_at) + k])
            at += len(found)
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return Block(join(hashes, np.uint64), names, join(item, np.int64), join(start, np.int64), join(length, np.int64))


def _shingles(block: Block, shingle: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By shingle size: hash, window and place of every shingle of every window (short windows have smaller shingles)."""
    hasher, out = Hasher(), {}
    size = np.minimum(block.length, shingle)
    for s in np.unique(size):
        runs = hasher.runs(block.hashes, int(s))
        windows = np.flatnonzero(size == s)
        count = block.length[windows] - s + 1
        of = np.repeat(windows, count)
        place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        out[int(s)] = (runs[block.start[of] + place], of, place)
    return out


class Lookup:
    """Membership of many hashes in a sorted table, with a bit filter in front."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[self._slot(table)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that are in the table, and their table index."""
        at = np.flatnonzero(self.bits[self._slot(hashes)] & allowed)
        index = np.minimum(np.searchsorted(self.table, hashes[at]), len(self.table) - 1)
        good = self.table[index] == hashes[at]
        return at[good], index[good]


def _counts(documents: DataFrame, tables: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """How often each benchmark shingle occurs in all documents."""
    shared = documents.sparkSession.sparkContext.broadcast(tables)

    def count(batches):
        hasher = Hasher()
        lookups = {s: Lookup(t) for s, t in shared.value.items()}
        totals = {s: np.zeros(len(t), np.int64) for s, t in shared.value.items()}
        for batch in batches:
            for _, _, hashes, first in _words_of(batch.column(0), hasher):
                for s, lookup in lookups.items():
                    _, index = lookup.find(hasher.runs(hashes, s), run_starts(first, s))
                    totals[s] += np.bincount(index, minlength=len(totals[s]))
        for s, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), s, np.int32)), pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["s", "i", "n"])

    out = {s: np.zeros(len(t), np.int64) for s, t in tables.items()}
    # At most one row per distinct shingle of the block reaches the driver.
    found = documents.select(documents.columns[-1]).mapInArrow(count, "s int, i int, n bigint").groupBy("s", "i").agg(F.sum("n").alias("n")).toPandas()
    for s, group in found.groupby("s"):
        out[int(s)][group["i"].to_numpy()] = group["n"].to_numpy()
    return out


def _prefixes(block: Block, shingle: int, containment: float, documents: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By shingle size: sorted prefix shingles, where each one's entries begin, and the entries' window and place."""
    shingles = _shingles(block, shingle)
    tables = {s: np.unique(h) for s, (h, _, _) in shingles.items()}
    counts = _counts(documents, tables)
    out = {}
    for s, (h, of, place) in shingles.items():
        rarity = counts[s][np.searchsorted(tables[s], h)]
        order = np.lexsort((place, rarity, of))
        h, of, place = h[order], of[order], place[order]
        total = block.length[of] - s + 1
        begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        rank = np.arange(len(of)) - np.repeat(begin, np.diff(np.append(begin, len(of))))
        kept = rank <= total - _required(total, containment)
        h, of, place = h[kept], of[kept], place[kept]
        order = np.argsort(h, kind="stable")
        h, of, place = h[order], of[order], place[order]
        begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        out[s] = (h[begin], np.append(begin, len(h)), of, place)
    return out


def _required(total: np.ndarray, containment: float) -> np.ndarray:
    return np.maximum(1, np.ceil(containment * total - 1e-9)).astype(np.int64)


def _verified(hashes, first, block, s, containment, at, window, place, runs, item_runs):
    """Which candidates (word index, window, place) are real; returns their starts and windows."""
    text = np.searchsorted(first, at, "right") - 1
    start, length = at - place, block.length[window]
    fits = (start >= first[text]) & (start + length <= first[text + 1])
    start, window, length = start[fits], window[fits], length[fits]
    once = np.unique(np.stack([start, window]), axis=1)
    start, window = once[0], once[1]
    length = block.length[window]
    equal = np.zeros(len(start), np.int64)
    for p in range(int(length.max(initial=0)) - s + 1):
        on = np.flatnonzero(p <= length - s)
        equal[on] += runs[start[on] + p] == item_runs[block.start[window[on]] + p]
    good = equal >= _required(length - s + 1, containment)
    return start[good], window[good]


def _block_hits(documents: DataFrame, block: Block, shingle: int, containment: float, keep_text: bool = False) -> DataFrame:
    """``documents`` (its last column is the text) with n_words, hits and items of one block."""
    prefixes = _prefixes(block, shingle, containment, documents) if len(block.item) else {}
    names_out = documents.columns if keep_text else documents.columns[:-1]
    shared = by_value(documents.sparkSession, (block, prefixes))

    def scan(batches):
        hasher = Hasher()
        block, prefixes = shared()
        lookups = {s: Lookup(p[0]) for s, p in prefixes.items()}
        item_runs = {s: hasher.runs(block.hashes, s) for s in prefixes}
        names = np.array(block.names, dtype=object)
        for batch in batches:
            for i, j, hashes, first in _words_of(batch.column(batch.num_columns - 1), hasher):
                starts, windows = [], []
                for s, (_, begin, of, place) in prefixes.items():
                    runs = hasher.runs(hashes, s)
                    at, index = lookups[s].find(runs, run_starts(first, s))
                    many = begin[index + 1] - begin[index]
                    entry = np.repeat(begin[index], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    a, w = _verified(hashes, first, block, s, containment, np.repeat(at, many), of[entry], place[entry], runs, item_runs[s])
                    starts.append(a)
                    windows.append(w)
                start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
                window = np.concatenate(windows) if windows else np.zeros(0, np.int64)
                text = np.searchsorted(first, start, "right") - 1
                hits, items = [[] for _ in range(i, j)], [[] for _ in range(i, j)]
                for t in np.unique(text):
                    own = text == t
                    length = block.length[window[own]]
                    covered = np.repeat(start[own], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                    hits[t] = np.unique(covered - first[t]).tolist()
                    items[t] = sorted(set(names[block.item[window[own]]].tolist()))
                yield pa.RecordBatch.from_arrays([
                    *[c.slice(i, j - i) for c in batch.columns[:len(names_out)]], pa.array(np.diff(first).astype(np.int64)),
                    pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())),
                ], [*names_out, "n_words", "hits", "items"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*names_out).schema.fields]
    return documents.mapInArrow(scan, ", ".join([*fields, FOUND]))


def _blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[Block]:
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    # A text of n characters has at most (n + 1) / 2 words.
    size = items.agg(F.sum(F.floor((F.length("text") + 1) / 2)).alias("n")).first()["n"] or 0
    count = max(1, -(-int(size) // block_words))
    dealt = items.withColumn("_b", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    for b in range(count):
        yield make_block(dealt.filter(F.col("_b") == b).drop("_b").toArrow(), window)


def benchmark_hits(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    containment: float = 1.0,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: doc_id, n_words, ``hits`` (indexes of covered words, ascending) and ``items`` (ids found).

    ``documents`` needs doc_id and text, ``benchmark`` item_id and text.
    """
    text = F.col("text").cast("string")
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(text, 256).alias("text_key"), text.alias("text"))
    each = [_block_hits(docs, block, shingle, containment) for block in _blocks(benchmark, window, block_words)]
    if len(each) == 1:
        return each[0].drop("text_key")
    found = each[0]
    for more in each[1:]:
        found = found.unionByName(more)
    # Rows that repeat (equal id and text) have merged; each block saw each of them once.
    merged = found.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.count(F.lit(1)).alias("_n"))
    copies = F.sequence(F.lit(1), (F.col("_n") / len(each)).cast("int"))
    return merged.select("doc_id", "n_words", "hits", "items", F.explode(copies).alias("_c")).drop("_c")


def clean_documents(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, containment: float = 1.0, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents, in all their columns, that hold no window of the benchmark; nothing is joined back."""
    rows = neutral(documents, ["text"])
    for number, block in enumerate(_blocks(benchmark, window, block_words)):
        # One block's index at a time is in the workers' memory.
        rows = checkpoint(rows) if number else rows
        rows = _block_hits(rows, block, shingle, containment, keep_text=True).filter(F.size("hits") == 0).select(*rows.columns)
    return restored(rows, documents, ["text"])


def contamination(documents: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The digest of :func:`benchmark_hits`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = benchmark_hits(documents, benchmark, **how)
    names = F.array_sort(F.array_distinct("items"))
    return hits.select(
        "doc_id", "n_words", F.size("hits").cast("bigint").alias("n_hit"), F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))
