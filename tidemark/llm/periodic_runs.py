"""Periodic runs of words, found as maximal pairs in each text's LCP-interval tree.

A run of smallest period q and length n >= 4q that no neighbouring word extends gives
a maximal pair: the two places q apart at its start have n - q >= 3q words in common,
the words before them differ and so do the words behind. The other way round, a maximal
pair of d common words at a distance of at most d / 3 is a run as it stands. So:

1. the suffixes of each text are sorted by prefix doubling, the common prefix (LCP) of neighbours
   is taken from hashes of word runs. Suffixes that share fewer than LEAST_COMMON words with any other are
   left out, as no run has so short a pair;
2. the tree of LCP intervals is walked bottom-up. A node holds, for each word that stands
   before a suffix (its left class), the list of places. When children are joined, each
   place of the smaller one is looked up in the lists of all other classes of the larger
   one, no further away than a third of the node's depth; what is found are the pairs;
3. of pairs with the same stretch the one with the least distance has the smallest period.

A place is joined at most log n times, and stretches of one run share their left class, so they
are passed over as a whole. Texts are independent; a task holds one chunk of them (at least one text).

Nulls: a null or empty text has no words and no runs. Rows with equal ids are texts of their own, other columns
are ignored. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import PLAIN_WORD, Hasher, find_words, joined_words, text_chunks

LEAST_WORDS = 6
LEAST_REPEATS = 4
LEAST_COMMON = 5
START = -1

FOUND = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _sorted_suffixes(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Word indices in the order of the suffixes of their texts, texts one after another; only those that share their first words with another."""
    n = len(words)
    end = np.repeat(first[1:], np.diff(first))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    _, ids = np.unique(words, return_inverse=True)
    # The rank of a suffix is where the group of suffixes that are equal so far begins.
    active, known = np.arange(n), 0
    rank, key = np.zeros(n, np.int64), text * np.int64(n + 1) + ids
    sorted_at = np.zeros(n, np.int64)
    while len(active):
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        new = np.append(True, key[1:] != key[:-1])
        # The groups of one earlier group follow one another from its own beginning on.
        begin = np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))
        if known:
            old = rank[active]
            fresh = np.append(True, old[1:] != old[:-1])
            place = old + begin - np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0))
        else:
            place = begin
        rank[active] = place
        sorted_at[place + np.arange(len(active)) - begin] = active
        known = 2 * known if known else 1
        tied = ~new | ~np.append(new[1:], True)
        active = active[tied]
        if known == 4:
            kept = active
        further = active + known
        inside = further < end[active]
        key = rank[active] * np.int64(n + 1) + np.where(inside, rank[np.minimum(further, n - 1)] + 1, 0)
    if known < 4:
        return np.zeros(0, np.int64)
    return sorted_at[np.sort(rank[kept])]


def _common(hasher: Hasher, words: np.ndarray, left: np.ndarray, right: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many words the suffixes at ``left`` and ``right`` have in common, at most up to ``end`` (of both their texts)."""
    up, down = hasher._of(1, len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:-1], out=sums[1:])
    common = np.zeros(len(left), np.int64)
    room = end - np.maximum(left, right)
    step = 1 << int(room.max(initial=1)).bit_length()
    while step:
        a, b = left + common, right + common
        fits = np.flatnonzero(common + step <= room)
        x, y = a[fits], b[fits]
        same = (sums[x + step] - sums[x]) * down[x] == (sums[y + step] - sums[y]) * down[y]
        common[fits[same]] += step
        step >>= 1
    return common


class _Node:
    """An LCP interval: its depth and the places of its suffixes by left class, each list ascending."""

    __slots__ = ("depth", "classes", "size")

    def __init__(self, depth: int, classes: dict[int, list[int]], size: int):
        self.depth, self.classes, self.size = depth, classes, size


def _pairs(places: dict[int, list[int]], larger: _Node, reach: int, held: set[int], left: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs of one of ``places`` and one place of ``larger``, at most ``reach`` apart, whose left classes differ."""
    classes = larger.classes
    for own, mine in places.items():
        if len(classes) == 1 and own in classes:
            continue
        for place in mine:
            if len(classes) <= 2 * reach:
                for other, theirs in classes.items():
                    if other != own:
                        at = bisect_left(theirs, place - reach)
                        while at < len(theirs) and theirs[at] <= place + reach:
                            yield place, theirs[at]
                            at += 1
            else:
                # More classes than places within reach: look at the places.
                for near in (*range(place - reach, place), *range(place + 1, place + reach + 1)):
                    if near in held and left[near] != own:
                        listed = classes.get(left[near])
                        if listed is not None:
                            at = bisect_left(listed, near)
                            if at < len(listed) and listed[at] == near:
                                yield place, near


def _join(node: _Node, child: _Node, found: dict[tuple[int, int], int], held: set[int], left: list[int]) -> None:
    """Adds a child's places to a node; new maximal pairs go to ``found`` as (start, length) -> least period."""
    depth = node.depth
    larger, smaller = (node, child) if node.size >= child.size else (child, node)
    for i, j in _pairs(smaller.classes, larger, depth // (LEAST_REPEATS - 1), held, left):
        start, period = (i, j - i) if i < j else (j, i - j)
        stretch = (start, depth + period)
        if period < found.get(stretch, period + 1):
            found[stretch] = period
    classes = larger.classes
    for own, places in smaller.classes.items():
        listed = classes.get(own)
        if listed is None:
            classes[own] = places
        elif places[0] > listed[-1]:
            listed += places
        elif 16 * len(places) < len(listed):
            for place in places:
                insort(listed, place)
        else:
            listed += places
            listed.sort()
    node.classes, node.size = classes, larger.size + smaller.size


def maximal_pairs(suffixes: list[int], common: list[int], left: list[int]) -> dict[tuple[int, int], int]:
    """(start, length) -> smallest period of all runs of one text.

    ``suffixes``: places in suffix order; ``common[k]``: words that suffixes k - 1 and k share (0 for k = 0); ``left``: for each place the word before it.
    """
    found: dict[tuple[int, int], int] = {}
    held = set(suffixes)
    stack: list[_Node] = []
    for k, place in enumerate(suffixes):
        last = _Node(0, {left[place]: [place]}, 1)
        following = common[k + 1] if k + 1 < len(suffixes) else 0
        if following < LEAST_COMMON:
            following = 0
        while stack and stack[-1].depth > following:
            node = stack.pop()
            _join(node, last, found, held, left)
            last = node
        if not following:
            continue
        if stack and stack[-1].depth == following:
            _join(stack[-1], last, found, held, left)
        else:
            stack.append(_Node(following, last.classes, last.size))
    return found


def _runs_of_chunk(hasher: Hasher, words: np.ndarray, first: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Text number -> its runs (start, length, period), by start, then period."""
    suffixes = _sorted_suffixes(words, first)
    if not len(suffixes):
        return {}
    texts = np.searchsorted(first, suffixes, "right") - 1
    end = first[texts + 1]
    common = np.zeros(len(suffixes), np.int64)
    common[1:] = np.where(texts[1:] == texts[:-1], _common(hasher, words, suffixes[:-1], suffixes[1:], np.minimum(end[1:], end[:-1])), 0)
    common[np.append(True, texts[1:] != texts[:-1])] = 0
    near = np.maximum(common, np.append(common[1:], 0)) >= LEAST_COMMON
    suffixes, texts, common = suffixes[near], texts[near], common[near]
    cuts = np.append(np.flatnonzero(np.append(True, texts[1:] != texts[:-1])), len(texts)) if len(texts) else np.zeros(0, int)
    runs = {}
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        text = int(texts[a])
        from_, to = int(first[text]), int(first[text + 1])
        _, ids = np.unique(words[from_:to], return_inverse=True)
        found = maximal_pairs((suffixes[a:b] - from_).tolist(), common[a:b].tolist(), [START, *ids[:-1].tolist()])
        if found:
            runs[text] = sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))
    return runs


def periodic_runs(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period; by start, then period) and ``collapsed``: the words left when each run keeps its first period only."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                starts, ends, first = find_words(data, offsets, PLAIN_WORD)
                runs = _runs_of_chunk(hasher, hasher.words(data, starts, ends), first)
                text, at, to = joined_words(data, starts, ends, first)
                collapsed, raw = [], None
                for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    if k not in runs:
                        collapsed.append(text[at[a]:to[b - 1]] if b > a else b"")
                        continue
                    raw = data.tobytes() if raw is None else raw
                    edge = np.zeros(b - a + 1, np.int64)
                    for start, length, period in runs[k]:
                        edge[start + period] += 1
                        edge[start + length] -= 1
                    kept = np.flatnonzero(np.cumsum(edge)[:-1] == 0) + a
                    collapsed.append(b" ".join([raw[s:e] for s, e in zip(starts[kept].tolist(), ends[kept].tolist())]))
                listed = [[{"start": s, "length": n, "period": p} for s, n, p in runs.get(k, ())] for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(np.diff(first).astype(np.int64)),
                    pa.array(listed, kind), pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, FOUND)


def strongest_run(runs: str = "runs") -> Column:
    """The run with the greatest length / period, compared exactly; of equals the one with the smallest start, then period. Null without runs."""
    best = F.reduce(runs, F.get(runs, 0), lambda x, r: F.when(r["length"] * x["period"] > x["length"] * r["period"], r).otherwise(x))
    return F.when(F.size(runs) > 0, best)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated_tail(doc_id: int | None, text: str | None) -> str | None:
    """The text, with every tenth id's words from some word on replaced by repeats of the next few. A null id leaves it unchanged."""
    number = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    words = WORD.findall(text or "") if number % 10 == 0 else []
    if not words:
        return text
    n, g = len(words), number // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    repeat = words[a:a + period]
    whole, rest = divmod(n - a, period)
    return " ".join(words[:a] + repeat * whole + repeat[:rest])


def with_repeated_tails(documents: DataFrame) -> DataFrame:
    """doc_id and text after :func:`repeated_tail`."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            chosen = np.array([i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in ids], bool)
            texts = batch.column(1)
            at = np.flatnonzero(chosen)
            if len(at):
                changed = pa.array([repeated_tail(ids[k], texts[k].as_py()) for k in at.tolist()], pa.string())
                where = np.arange(len(ids))
                where[at] = len(ids) + np.arange(len(at))
                texts = pa.concat_arrays([texts.cast(pa.string()), changed]).take(pa.array(where))
            yield pa.RecordBatch.from_arrays([batch.column(0), texts.cast(pa.string())], ["doc_id", "text"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, "doc_id bigint, text string")
