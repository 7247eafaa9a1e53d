"""Substring deduplication by relative Lempel-Ziv parsing against indexed reference blocks.

Documents are cut into content-defined blocks: the least hash among the
``window - ANCHOR + 1`` runs of ANCHOR words in a window is the window's anchor,
and a block is a run of windows with the same anchor (so it depends on content
only, and equal windows have equal anchors). Each distinct block is indexed once, where it
occurs first (least document, then place); these blocks are the reference text.

1. Matches: a block indexed under a smaller document matches there whole. In a block that is the
   first of its kind, each window is looked up among all windows of reference blocks
   with the same anchor; a smaller document that has the window has it in such a
   block, and its first occurrence is the match.
2. Parse (:func:`greedy_factors`): as a window has one place in the reference, the longest factor at a
   word is the run of windows that go on in the same document word by word, across
   block borders. The parse takes it and goes on where it ends.
3. Boundaries: a factor that begins where another one ends is also followed to the left, into the
   other. With these words it has ``window`` or more, or it is none. Factors with the words to
   their left are the duplicate spans.

A window is thus found exactly if its word sequence starts in a document with a
smaller id. Sequences are compared by 64-bit hashes; windows, which decide one by
one, by 96 bits. Hot blocks and hot windows are combined before the shuffle (the
index keeps one row), and the joins that bring the index back are plain
shuffle joins, whose skewed partitions adaptive execution splits.

Nulls: a null or empty text has no words. A null doc_id compares as 2^63 - 1, the largest id,
and stays null in the result; rows without an id do not find each other. Rows with equal id find each
other's windows only in smaller ids; a factor then names the id, and a place in one of its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import PLAIN_WORD, Hasher, find_words, joined_words, run_starts, text_chunks
from tidemark.sources.durable import checkpoint

WINDOW = 50
ANCHOR = 24
NO_ID = 2**63 - 1
_U = np.uint64

BLOCKS = "doc bigint, key bigint, n_words bigint, kept_sha256 string, blocks array<struct<anchor:bigint,digest:bigint,at:int,n:int>>"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value among each ``width`` neighbours."""
    n = len(values)
    index = np.arange(n)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = index[:len(index) - step], index[step:]
        index = np.where(values[right] < values[left], right, left)
        reach += step
    return index[:n - width + 1]


def _cut_blocks(hasher: Hasher, hashes: np.ndarray, first: np.ndarray, window: int, anchor: int):
    """Blocks of all texts of a chunk: first window (word index), number of windows, anchor hash, digest."""
    if int(first[-1]) < window:
        none = np.zeros(0, np.int64)
        return none, none, none.view(_U), none.view(_U)
    grams = hasher.runs(hashes, anchor)
    where = _sliding_min(grams, window - anchor + 1)
    valid = run_starts(first, window)
    at = np.flatnonzero(valid)
    if not len(at):
        return at, at, at.view(_U), at.view(_U)
    where = where[at]
    new = np.append(True, (where[1:] != where[:-1]) | (at[1:] != at[:-1] + 1))
    begin = at[new]
    count = np.diff(np.append(np.flatnonzero(new), len(at)))
    # The digest of a block covers all words of its windows; its length and the anchor's place go in.
    up, down = hasher._of(1, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, _U)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    end = begin + count + window - 1
    digest = (sums[end] - sums[begin]) * down[begin]
    digest = digest * _U(0x9E3779B97F4A7C15) + count.astype(_U) * _U(0xC2B2AE3D27D4EB4F) + (where[new] - begin).astype(_U)
    return begin, count, grams[where[new]], digest ^ (digest >> _U(29))


def _sha(text: bytes, left: int, right: int) -> str:
    return hashlib.sha256(text[left:right]).hexdigest()


def cut_documents(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Of (doc, text, key) rows: doc, key, n_words, the digest of all words joined by a space, and the blocks."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        kind = pa.struct([("anchor", pa.int64()), ("digest", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                starts, ends, first = find_words(data, offsets, PLAIN_WORD)
                hashes = hasher.words(data, starts, ends)
                text, at, to = joined_words(data, starts, ends, first)
                begin, count, anchors, digests = _cut_blocks(hasher, hashes, first, window, anchor)
                of = np.searchsorted(first, begin, "right") - 1
                # Texts without words share a first word; the last of them is the one that has it.
                cut = np.searchsorted(of, np.arange(j - i + 1))
                blocks = pa.StructArray.from_arrays([
                    pa.array(anchors.view(np.int64)), pa.array(digests.view(np.int64)),
                    pa.array((begin - first[of]).astype(np.int32)), pa.array(count.astype(np.int32))], fields=list(kind))
                shas = [_sha(text, at[a], to[b - 1]) if b > a else _sha(b"", 0, 0) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(np.diff(first).astype(np.int64)),
                    pa.array(shas, pa.string()), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), blocks),
                ], ["doc", "key", "n_words", "kept_sha256", "blocks"])

    return documents.mapInArrow(scan, BLOCKS)


def _window_hashes(asked: DataFrame, window: int) -> DataFrame:
    """Rows (h, c, doc, key, at) for each window of the asked ranges of each text."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, second = Hasher(), Hasher(2)
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(2)):
                starts, ends, first = find_words(data, offsets, PLAIN_WORD)
                runs = hasher.runs(hasher.words(data, starts, ends), window)
                checks = second.runs(second.words(data, starts, ends), window)
                ranges = batch.column(3).slice(i, j - i)
                many = ranges.value_lengths().to_numpy(zero_copy_only=False)
                flat = ranges.flatten()
                row = np.repeat(np.arange(j - i), many)
                at, n = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                local = np.repeat(at, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row = np.repeat(row, n)
                word = first[row] + local
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([
                    pa.array(runs[word].view(np.int64)), pa.array((checks[word] >> _U(32)).astype(np.uint32).view(np.int32)),
                    batch.column(0).slice(i, j - i).take(take), batch.column(1).slice(i, j - i).take(take), pa.array(local.astype(np.int32)),
                ], ["h", "c", "doc", "key", "at"])

    return asked.select("doc", "key", "text", "asked").mapInArrow(scan, "h bigint, c int, doc bigint, key bigint, at int")


def greedy_factors(row: np.ndarray, at: np.ndarray, n: np.ndarray, ref: np.ndarray, ref_at: np.ndarray, window: int):
    """Greedy parse of texts (``row``) by matches of the windows at..at+n-1 with those from ref_at on of document ``ref``.

    Of each factor: its row, first and end word, its reference document, the place of its first word there, and how many
    words before it, which an earlier factor has, match as well.
    """
    order = np.lexsort((at, row))
    row, at, n, ref, ref_at = (x[order] for x in (row, at, n, ref, ref_at))
    goes_on = (row[1:] == row[:-1]) & (ref[1:] == ref[:-1]) & (at[1:] == at[:-1] + n[:-1]) & (at[1:] - ref_at[1:] == at[:-1] - ref_at[:-1])
    begins = np.flatnonzero(np.append(True, ~goes_on)) if len(row) else np.zeros(0, np.int64)
    last = np.append(begins[1:], len(row)) - 1
    row, left, end = row[begins], at[begins], at[last] + n[last] + window - 1
    # Windows have one match each, so factors end in the order they begin.
    start = left.copy()
    start[1:] = np.where(row[1:] == row[:-1], np.maximum(left[1:], end[:-1]), left[1:])
    back = start - left
    return row, start, end, ref[begins], ref_at[begins] + back, back


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_FACTOR = [("start", pa.int32()), ("end", pa.int32()), ("ref", pa.int64()), ("ref_start", pa.int32()), ("back", pa.int32())]
SPANS = "array<struct<start:int,end:int>>"
FACTORS = "array<struct<start:int,end:int,ref:bigint,ref_start:int,back:int>>"


def _kept(matched: DataFrame, window: int) -> DataFrame:
    """Parses texts by their matches: n_words, n_removed, the digest of the kept words, the factors and the spans."""
    schema = f"doc bigint, key bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans {SPANS}, factors {FACTORS}"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(2)):
                starts, ends, first = find_words(data, offsets, PLAIN_WORD)
                matches = batch.column(3).slice(i, j - i)
                many = matches.value_lengths().to_numpy(zero_copy_only=False)
                flat = matches.flatten()
                fields = [flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)]
                row, start, end, ref, ref_start, back = greedy_factors(np.repeat(np.arange(j - i), many), *fields, window)
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, first[row] + start - back, 1)
                np.add.at(edge, first[row] + end, -1)
                gone = np.cumsum(edge)[:-1] > 0
                raw, shas, spans, removed = data.tobytes(), [], [], []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    cut = gone[a:b]
                    left = np.flatnonzero(~cut) + a
                    shas.append(hashlib.sha256(b" ".join([raw[s:e] for s, e in zip(starts[left].tolist(), ends[left].tolist())])).hexdigest())
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
                    spans.append([{"start": int(s), "end": int(e)} for s, e in turns.reshape(-1, 2)])
                    removed.append(int(cut.sum()))
                factors = pa.StructArray.from_arrays(
                    [pa.array(x, kind) for x, (_, kind) in zip((start, end, ref, ref_start, back), _FACTOR)], fields=[pa.field(*f) for f in _FACTOR])
                cut = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(np.diff(first).astype(np.int64)),
                    pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(spans, _SPANS),
                    pa.ListArray.from_arrays(pa.array(cut), factors),
                ], ["doc", "key", "n_words", "n_removed", "kept_sha256", "spans", "factors"])

    return matched.select("doc", "key", "text", "matches").mapInArrow(scan, schema)


def substring_dedup(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by a space), ``spans`` (removed word ranges), ``factors``.

    A factor has its words [start, end), the document ``ref`` that has them from word ``ref_start`` on, and ``back``: how
    many words before ``start``, which an earlier factor has, match there as well.
    """
    text = F.col("text").cast("string")
    given = F.col("doc_id").cast("bigint")
    # The key tells texts of equal doc_id apart; its lowest bit says that the row has no id.
    key = F.shiftleft(F.xxhash64(text), 1) + given.isNull().cast("bigint")
    docs = documents.select(F.coalesce(given, F.lit(NO_ID)).alias("doc"), text.alias("text"), key.alias("key"))
    cut = checkpoint(cut_documents(docs, window, anchor))
    blocks = cut.select("doc", "key", F.explode("blocks").alias("_b")).select("doc", "key", "_b.*")
    place = F.min(F.struct("doc", "at")).alias("_first")
    index = blocks.groupBy("digest", "anchor").agg(place, F.max("doc").alias("_last"))
    index = checkpoint(index.select("digest", "anchor", F.col("_first.doc").alias("ref"), F.col("_first.at").alias("ref_at"), "_last"))
    # Anchors whose blocks differ: there, windows of first blocks may still be copies.
    unsure = index.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("anchor", F.lit(True).alias("_unsure"))
    marked = index.join(unsure, "anchor", "left").select("digest", "anchor", "ref", "ref_at", "_last", F.coalesce("_unsure", F.lit(False)).alias("unsure"))
    placed = blocks.join(marked.filter("unsure or _last > ref").drop("_last"), ["digest", "anchor"]).filter("doc > ref or unsure")
    found = checkpoint(placed.groupBy("doc", "key").agg(
        F.collect_set(F.when(F.col("doc") > F.col("ref"), F.struct("at", "n", "ref", "ref_at"))).alias("copied"),
        F.collect_set(F.when(F.col("doc") == F.col("ref"), F.struct("at", "n"))).alias("asked")))
    asked = docs.join(found.filter(F.size("asked") > 0).select("doc", "key", "asked"), ["doc", "key"])
    windows = checkpoint(_window_hashes(asked, window))
    least = windows.groupBy("h", "c").agg(place, F.max("doc").alias("_last")).filter("_last > _first.doc")
    least = least.select("h", "c", F.col("_first.doc").alias("ref"), F.col("_first.at").alias("ref_at"))
    later = windows.join(least, ["h", "c"]).filter("doc > ref").groupBy("doc", "key").agg(
        F.collect_set(F.struct("at", F.lit(1).alias("n"), "ref", "ref_at")).alias("single"))
    none = F.array().cast("array<struct<at:int,n:int,ref:bigint,ref_at:int>>")
    matches = found.join(later, ["doc", "key"], "left").select("doc", "key", F.concat("copied", F.coalesce("single", none)).alias("matches"))
    matches = checkpoint(matches.filter(F.size("matches") > 0))
    shortened = _kept(docs.join(matches, ["doc", "key"]), window)
    whole = cut.select("doc", "key", "n_words", "kept_sha256").join(matches.select("doc", "key"), ["doc", "key"], "left_anti")
    result = whole.select(
        "doc", "key", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256",
        F.array().cast(SPANS).alias("spans"), F.array().cast(FACTORS).alias("factors")).unionByName(shortened)
    return result.select(
        F.when(F.col("key").bitwiseAND(1) == 0, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "spans", "factors")
