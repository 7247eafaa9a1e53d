"""Licence scans: runs of words compared to licence templates by the Dice coefficient over word bigrams.

Texts are normalised to lower-case words of letters and digits; lines mean nothing. For every template
T the runs R of consecutive words are sought whose bigram multisets have

    2 |R and T| / (|R| + |T|) >= least

Of a document's runs, the highest score, then the larger template, then the earlier, then the shorter run win;
runs that share a word with a winner are left out. Pruning loses nothing:

* |R| lies between least / (2 - least) and its inverse times |T|, and |R and T| is at least the first of
  these. Where fewer bigrams of T start within the longest run, no run begins.
* A run of highest score begins and ends with a bigram of T, as it would gain without another one.
* Runs are taken best first: for each template and first word the heap holds an upper bound, then the exact
  best. A run that meets a winner is weighed again up to the winner's first word, which can only lower it.

So the work is in places dense with a template's bigrams, and the memory a few numbers for each of them. One pass
without a shuffle; templates are a parameter of bounded size (:func:`read_templates`).

Nulls: a null or empty text matches nothing. Each row has one result.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.licence_texts import TEMPLATES
from tidemark.llm.words import ALNUM_WORD, LOWER, Hasher, find_words, text_chunks

LEAST = 0.8
TEMPLATE_BYTES = 64 << 20
MATCHES = "array<struct<licence:string,template:int,dice:double,first_word:int,end_word:int,first_line:int,last_line:int>>"
_KIND = pa.struct([
    ("licence", pa.string()), ("template", pa.int32()), ("dice", pa.float64()),
    ("first_word", pa.int32()), ("end_word", pa.int32()), ("first_line", pa.int32()), ("last_line", pa.int32())])
_EDGE = 1e-9


@dataclass
class Templates:
    """The distinct bigrams of all templates, and of each: name, size, and the count of every bigram of the table in it."""

    table: np.ndarray
    names: list[str]
    sizes: list[int]
    counts: list[np.ndarray]


def prepared(templates: Sequence[tuple[str, str]]) -> Templates:
    hasher, found = Hasher(), []
    for _, text in templates:
        data = LOWER[np.frombuffer(text.encode(), np.uint8)]
        starts, ends, _ = find_words(data, np.array([0, len(data)]), ALNUM_WORD)
        found.append(hasher.runs(hasher.words(data, starts, ends), 2))
    table = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    counts = [np.bincount(np.searchsorted(table, b), minlength=len(table)).astype(np.int32) for b in found]
    return Templates(table, [name for name, _ in templates], [len(b) for b in found], counts)


def read_templates(spark: SparkSession, path: str, most: int = TEMPLATE_BYTES) -> list[tuple[str, str]]:
    """(licence, text) of the files below ``path``, one licence each, named by the file without ``.txt``; refused above ``most`` bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    total = files.agg(F.sum("length")).first()[0] or 0
    if total > most:
        raise ValueError(f"templates of {total} bytes below {path}; at most {most}")
    rows = files.select("path", F.decode("content", "UTF-8").alias("text")).orderBy("path").collect()
    return [(r.path.rsplit("/", 1)[1].removesuffix(".txt"), r.text) for r in rows]


class _Places:
    """The bigrams of one text that one template has, and what the best run from each of them reaches."""

    def __init__(self, index: np.ndarray, counts: np.ndarray, total: int, least: float):
        self.total, self.least = total, least
        low = least / (2 - least)
        self.shortest, self.longest = low * total - _EDGE, total / low + _EDGE
        allowed = np.where(index >= 0, counts[index], 0)
        self.at = np.flatnonzero(allowed)
        reach = np.searchsorted(self.at, self.at + int(self.longest))
        self.bound = np.minimum(reach - np.arange(len(self.at)), total)
        self.begins = np.flatnonzero(self.bound >= self.shortest)
        # A bigram counts in a run only if the run begins behind ``before``: else the template's copies are used up.
        self.before = np.full(len(self.at), -1, np.int64)
        if len(self.begins):
            order = np.argsort(index[self.at], kind="stable")
            kind, copies = index[self.at][order], allowed[self.at][order]
            back = np.arange(len(order)) - copies
            same = (back >= 0) & (kind[np.maximum(back, 0)] == kind)
            self.before[order[same]] = self.at[order[back[same]]]

    def highest(self, k: int) -> float:
        return 2 * int(self.bound[k]) / (int(self.bound[k]) + self.total)

    def best(self, k: int, end: int) -> tuple[float, int] | None:
        """The highest score of a run from place ``k`` whose words lie before ``end``, and its last bigram; the shortest of equal ones."""
        first = int(self.at[k])
        to = np.searchsorted(self.at, min(first + int(self.longest), end - 1))
        last = self.at[k:to]
        size = last - first + 1
        shared = np.cumsum(self.before[k:to] < first)
        score = 2 * shared / (size + self.total)
        if not len(score) or score.max() < self.least:
            return None
        top = int(np.argmax(score))
        return float(score[top]), int(last[top])


def best_matches(templates: Templates, index: np.ndarray, least: float) -> list[tuple[float, int, int, int]]:
    """(score, template, first word, end word) of one text, by first word; ``index`` is the table index of each bigram, -1 if none."""
    places, heap = {}, []
    for number, total in enumerate(templates.sizes):
        if not total:
            continue
        own = _Places(index, templates.counts[number], total, least)
        if len(own.begins):
            places[number] = own
            heap += [(-own.highest(k), -total, int(own.at[k]), -1, number, k) for k in own.begins.tolist()]
    heapify(heap)
    taken = []
    while heap:
        dice, total, first, end, number, k = heappop(heap)
        after = bisect_right(taken, (first, len(index) + 2))
        if after and taken[after - 1][1] > first:
            continue
        limit = taken[after][0] if after < len(taken) else len(index) + 1
        if 0 <= end <= limit:
            insort(taken, (first, end, -dice, number))
            continue
        found = places[number].best(k, limit)
        if found:
            heappush(heap, (-found[0], total, first, found[1] + 2, number, k))
    return [(score, number, first, end) for first, end, score, number in taken]


def scan_licences(documents: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """doc_id and ``matches`` of every document: licence, template, dice, words [first_word, end_word) and their lines, counted from 0."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, ready = Hasher(), prepared(templates)
        # A text with fewer known bigrams than the shortest run shares has no match.
        need = least / (2 - least) * min(filter(None, ready.sizes), default=0) - _EDGE
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                lowered = LOWER[data]
                starts, ends, first = find_words(lowered, offsets, ALNUM_WORD)
                rows = [[] for _ in range(i, j)]
                bigrams = hasher.runs(hasher.words(lowered, starts, ends), 2)
                if len(ready.table) and len(bigrams):
                    at = np.minimum(np.searchsorted(ready.table, bigrams), len(ready.table) - 1)
                    index = np.where(ready.table[at] == bigrams, at, -1)
                    breaks = np.concatenate([[0], np.cumsum(data == 0x0A)])
                    line = breaks[starts]
                    known = np.concatenate([[0], np.cumsum(index >= 0)])
                    for t in range(j - i):
                        a, b = int(first[t]), int(first[t + 1])
                        if b - a < 2 or known[b - 1] - known[a] < need:
                            continue
                        base = breaks[offsets[t]]
                        rows[t] = [{
                            "licence": ready.names[number], "template": number, "dice": score, "first_word": begin, "end_word": end,
                            "first_line": int(line[a + begin] - base), "last_line": int(line[a + end - 1] - base),
                        } for score, number, begin, end in best_matches(ready, index[a:b - 1], least)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(rows, pa.list_(_KIND))], ["doc_id", "matches"])

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(scan, f"doc_id bigint, matches {MATCHES}")
