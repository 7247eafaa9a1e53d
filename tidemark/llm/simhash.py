"""SimHash near-duplicate detection by the generalised pigeonhole principle.

Every distinct fingerprint is split into m parts with thresholds t_1 + ... + t_m =
distance - m + 1 (a part with t = -1 is not looked at). Two fingerprints within
``distance`` bits agree within t_i bits on some part i, so comparing each with
all whose part is within t_i bits of its own finds every link; what is found is
verified on the whole fingerprint.

* Correlated bits go into the same part: bits are ordered greedily by their
  correlation over all fingerprints, parts are runs of four-bit blocks of it.
* Thresholds come from dynamic programming over estimated candidate counts: the
  exact pair-distance distribution of each block (from its 16-value histogram
  over all fingerprints), convolved over the blocks of a part. The number of
  parts is chosen by the same cost.
* Copies share a fingerprint and are one row from the start. Fingerprints are dealt
  over slices by hash and a task is given two slices, each pair of them once. It sorts
  them by each part and compares the rows of a value with those of all values near it, in numpy:
  no probe is shuffled, and rows that share a value are spread over all tasks.
  A task gives the edges of a spanning forest, never its pairs. No link is lost.

``near_duplicates`` can ask for a second code, the lowest bits of 64 min-hashes,
which estimates the Jaccard similarity of the shingle sets; a link then needs both.

Nulls: a null or empty text has fingerprint zero and links like any other. A null
doc_id is a row of its own; it takes no part in the least id of its component,
and a component of such rows only has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import neutral, restored
from tidemark.llm.near_copies import similar_groups
from tidemark.llm.words import LOWER, PLAIN_WORD, find_words, joined_words, text_chunks
from tidemark.operators.components import components
from tidemark.sources.durable import checkpoint

BITS = 64
BLOCK_BITS = 4
RUN_BITS = 8
PARTS = range(4, 9)
# Most rows of a slice, rows from which on there are more slices than that asks for, and how many.
BUCKET_ROWS, SPREAD_ROWS, SPREAD = 1 << 19, 1 << 13, 8
# Cost of the rows of one value of a part, of a row gathered for them and of verifying a candidate pair, in seconds.
GROUP_COST, ROW_COST, PAIR_COST = 4e-5, 4e-9, 1e-9
_TILE, _FOLD = 1 << 18, 1 << 20
_U = np.uint64
_CHUNK = 1 << 18


def _min_bits(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The lowest bits of 64 min-hashes of each run of shingle hashes."""
    rng = np.random.Generator(np.random.PCG64(5))
    factors = rng.integers(0, 2**64, 64, dtype=_U) | _U(1)
    adds = rng.integers(0, 2**64, 64, dtype=_U)
    out = np.zeros(len(begin), _U)
    for k in range(64):
        # The multiplier's high half orders the shingles; bit 32 of the least one is kept.
        least = np.minimum.reduceat(hashes * factors[k] + adds[k], begin)
        out |= ((least >> _U(17)) & _U(1)) << _U(k)
    return out


def fingerprints(documents: DataFrame, shingle: int = 4, with_check: bool = False) -> DataFrame:
    """The SimHash of the XXH64 (seed 42) of lower-cased word shingles, as a signed long.

    Takes ``text`` away and adds fp (and check).
    """
    rest = [c for c in documents.columns if c != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(len(rest)), _CHUNK):
                lowered = LOWER[data]
                starts, ends, first = find_words(lowered, offsets, PLAIN_WORD)
                text, at, to = joined_words(lowered, starts, ends, first)
                many = np.diff(first)
                count = np.where(many == 0, 0, np.maximum(many - shingle + 1, 1))
                of = np.repeat(np.arange(len(many)), count)
                begin = np.cumsum(count) - count
                left = first[:-1][of] + np.arange(len(of)) - begin[of]
                right = np.minimum(left + shingle, first[1:][of]) - 1
                digest = xxhash.xxh64_intdigest
                hashes = np.fromiter((digest(text[a:b], 42) for a, b in zip(at[left].tolist(), to[right].tolist())), _U, len(of))
                fp, check = np.zeros(len(many), _U), np.zeros(len(many), _U)
                full = np.flatnonzero(count)
                if len(full):
                    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    ones = np.add.reduceat(bits, begin[full], axis=0, dtype=np.int64)
                    packed = np.packbits(2 * ones > count[full][:, None], axis=1, bitorder="little")
                    fp[full] = packed.view(_U).ravel()
                    if with_check:
                        check[full] = _min_bits(hashes, begin[full])
                columns = [c.slice(i, j - i) for c in batch.columns[:len(rest)]] + [pa.array(fp.view(np.int64))]
                if with_check:
                    columns.append(pa.array(check.view(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, [*rest, "fp", "check"][:len(columns)])

    docs = documents.select(*rest, F.col("text").cast("string").alias("text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema.fields]
    return docs.mapInArrow(scan, ", ".join([*fields, "fp bigint"] + ["check bigint"] * with_check))


@dataclass
class Plan:
    """Bits of each part that is probed, and its threshold."""

    parts: list[tuple[tuple[int, ...], int]]
    cost: float


def _bit_order(nodes: DataFrame, n: int) -> list[int]:
    """All bits, each run of eight as correlated as a greedy choice makes it."""
    def moments(batches):
        total = np.zeros((BITS, BITS))
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(_U)
            for at in range(0, len(fp), 1 << 16):
                bits = ((fp[at:at + (1 << 16), None] >> np.arange(BITS, dtype=_U)) & _U(1)).astype(np.float32)
                total += bits.T @ bits
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j].astype(np.int64))], ["i", "j", "n"])

    both = np.zeros((BITS, BITS))
    for row in nodes.select("fp").mapInArrow(moments, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        both[row["i"], row["j"]] = both[row["j"], row["i"]] = row["n"]
    mean = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    related = np.abs(both / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread)
    left, order = list(range(BITS)), []
    while left:
        if len(order) % RUN_BITS == 0:
            block = [max(left, key=lambda b: (related[b, left].sum() - related[b, b], -b))]
        else:
            block.append(max(left, key=lambda b: (related[b, block].sum(), -b)))
        order.append(block[-1])
        left.remove(block[-1])
    return order


def _take_bits(fp: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(fp), _U)
    for k, b in enumerate(bits):
        out |= ((fp >> _U(b)) & _U(1)) << _U(k)
    return out


def _block_distances(nodes: DataFrame, order: list[int]) -> list[np.ndarray]:
    """For each block of bits, how many ordered pairs of fingerprints differ in d of them."""
    values = 1 << BLOCK_BITS
    blocks = [tuple(order[k:k + BLOCK_BITS]) for k in range(0, BITS, BLOCK_BITS)]
    value = lambda bits: sum(F.shiftleft(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1)), k) for k, b in enumerate(bits))
    keyed = nodes.select(F.explode(F.array(*[(value(bits) + values * k).cast("int") for k, bits in enumerate(blocks)])).alias("v"))
    counts = np.zeros(values * len(blocks))
    for row in keyed.groupBy("v").count().collect():
        counts[row["v"]] = row["count"]
    apart = np.bitwise_count(np.arange(values)[:, None] ^ np.arange(values)[None, :])
    out = []
    for k in range(len(blocks)):
        c = counts[values * k:values * (k + 1)]
        out.append(np.bincount(apart.ravel(), np.outer(c, c).ravel(), BLOCK_BITS + 1))
    return out


def plan_parts(order: list[int], distances: list[np.ndarray], n: int, distance: int, slices: int = 1) -> Plan:
    """The cheapest layout and thresholds; within a layout by dynamic programming over the parts."""
    best = Plan([], float("inf"))
    unit, tasks = BITS // len(distances), slices * (slices + 1) / 2
    for many in PARTS:
        layout = [len(distances) // many + (k < len(distances) % many) for k in range(many)]
        budget = distance - len(layout) + 1
        if budget < -len(layout):
            continue
        tables, parts, at = [], [], 0
        for blocks in layout:
            spread = np.ones(1)
            for d in distances[at:at + blocks]:
                spread = np.convolve(spread, d / max(d.sum(), 1))
            width = unit * blocks
            pairs = np.cumsum(spread) * n * n / 2
            gathered = np.cumsum([comb(width, t) for t in range(width + 1)]) * n * (slices + 1) / 2
            # Entry t + 1: the cost of threshold t; a part of threshold -1 costs nothing.
            fixed = GROUP_COST * min(1 << width, n / slices) * tasks
            tables.append(np.concatenate([[0.0], fixed + ROW_COST * gathered + PAIR_COST * pairs])[:distance + 2])
            parts.append(tuple(order[unit * at:unit * (at + blocks)]))
            at += blocks
        need = budget + len(layout)
        cost, chosen = np.full(need + 1, np.inf), []
        cost[0] = 0
        for table in tables:
            step, pick = np.full(need + 1, np.inf), np.zeros(need + 1, int)
            for total in range(need + 1):
                for own in range(min(total, len(table) - 1) + 1):
                    c = cost[total - own] + table[own]
                    if c < step[total]:
                        step[total], pick[total] = c, own
            cost = step
            chosen.append(pick)
        if cost[need] < best.cost:
            total, thresholds = need, []
            for pick in reversed(chosen):
                thresholds.append(int(pick[total]) - 1)
                total -= int(pick[total])
            best = Plan([(p, t) for p, t in zip(parts, reversed(thresholds)) if t >= 0], float(cost[need]))
    return best


def _slices(n: int) -> int:
    """Slices of n fingerprints: more than memory asks for, so that all cores have pairs of them."""
    return max(1, -(-n // BUCKET_ROWS), min(SPREAD, -(-n // SPREAD_ROWS)))


def _dealt(nodes: DataFrame, slices: int, columns: list[str]) -> DataFrame:
    """Rows (task, second, node columns): each pair of slices is a task, ``second`` marks the rows of the second one."""
    own = F.pmod(F.xxhash64(*columns), F.lit(slices)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    task = (high * (high + 1) / 2 + low).cast("int")
    rows = nodes.select(*columns, own.alias("_own")).withColumn("_other", other)
    rows = rows.select(task.alias("task"), (F.col("_own") > F.col("_other")).alias("second"), *columns)
    return rows.repartitionById(slices * (slices + 1) // 2, F.col("task")).sortWithinPartitions("task")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links a[i] - b[i]."""
    if not len(a):
        return a, b
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    label = np.arange(len(names))
    while True:
        least = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], least)
        np.minimum.at(label, label[y], least)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        label = label[label]
        if np.array_equal(label, before):
            break
    leaf = np.flatnonzero(label != np.arange(len(names)))
    return names[leaf], names[label[leaf]]


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of two lists of fingerprints that differ in ``distance`` or fewer bits, tile by tile."""
    width = min(len(b), _TILE)
    high = max(1, _TILE // max(width, 1))
    for p in range(0, len(a), high):
        for q in range(0, len(b), width):
            near = np.bitwise_count(a[p:p + high, None] ^ b[None, q:q + width]) <= distance
            hit = np.flatnonzero(near)
            if len(hit):
                x, y = np.divmod(hit, near.shape[1])
                yield p + x, q + y


def _part_links(a: np.ndarray, b: np.ndarray | None, bits: tuple[int, ...], t: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a and b (None: of a itself) that differ in at most t of some bits and in at most ``distance`` of all."""
    def by_value(fp):
        value = _take_bits(fp, bits).astype(np.int64)
        order = np.argsort(value, kind="stable")
        return order, fp[order], np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << len(bits)))])

    order_a, a, first_a = by_value(a)
    order_b, b, first_b = (order_a, a, first_a) if b is None else by_value(b)
    flips = np.array([sum(1 << k for k in chosen) for r in range(t + 1) for chosen in combinations(range(len(bits)), r)], np.int64)
    for value in np.flatnonzero(np.diff(first_a)).tolist():
        near = value ^ flips
        if order_b is order_a:
            near = near[near >= value]  # each pair of values once
        low = first_b[near]
        size = first_b[near + 1] - low
        rows = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        if len(rows):
            at = first_a[value]
            for x, y in _near(a[at:first_a[value + 1]], b[rows], distance):
                yield order_a[at + x], order_b[rows[y]]


def _verify(plan: Plan, distance: int, agree: int, columns: list[str]):
    names = [f"{c}_{side}" for side in "ab" for c in columns]

    def task_edges(table: pa.Table) -> pa.RecordBatch:
        """Forest edges of the links between two slices, or inside one; the links found so far are folded in between."""
        second = table.column("second").to_numpy(zero_copy_only=False)
        order = np.argsort(second, kind="stable")
        values = [table.column(c).to_numpy().view(_U)[order] for c in columns]
        n, cut = len(order), int(np.count_nonzero(~second))
        # Of one slice, all rows are of the first; of two, a task without rows of the second has no pairs.
        task = table.column("task")[0].as_py()
        corner = int((np.sqrt(8 * task + 1) - 1) / 2)
        inside = task == corner * (corner + 3) // 2
        fp = values[0]
        u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        found, many = [], 0

        def fold(u, v):
            return _forest(np.concatenate([u, *(x for x, _ in found)]), np.concatenate([v, *(y for _, y in found)]))

        if inside or 0 < cut < n:
            for bits, t in plan.parts:
                for x, y in _part_links(fp[:cut], None if inside else fp[cut:], bits, t, distance):
                    y = y if inside else y + cut
                    keep = x != y
                    if len(values) > 1:
                        keep &= np.bitwise_count(values[1][x] ^ values[1][y]) <= BITS - agree
                    found.append((x[keep], y[keep]))
                    many += len(x)
                    if many > _FOLD:
                        u, v = fold(u, v)
                        found, many = [], 0
        u, v = fold(u, v)
        return pa.RecordBatch.from_arrays([pa.array(c[side].view(np.int64)) for side in (u, v) for c in values], names)

    def tasks_of(held: list[pa.RecordBatch]) -> list[pa.Table]:
        table = pa.Table.from_batches(held).combine_chunks()
        task = table.column("task").to_numpy()
        begin = [0, *(np.flatnonzero(np.diff(task)) + 1).tolist(), len(task)]
        return [table.slice(i, j - i) for i, j in zip(begin, begin[1:])]

    def scan(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if held[0].column("task")[0] != batch.column("task")[-1]:
                *whole, rest = tasks_of(held)
                yield from map(task_edges, whole)
                held = rest.to_batches()
        if held:
            yield from map(task_edges, tasks_of(held))

    return scan, ", ".join(f"{n} bigint" for n in names)


def _components(prints: DataFrame, distance: int, agree: int | None) -> DataFrame:
    """``prints`` with ``component``, a number shared by all rows that links connect."""
    columns = ["fp"] if agree is None else ["fp", "check"]
    nodes = checkpoint(prints.select(*columns).distinct())
    n = nodes.count()
    order = _bit_order(nodes, n)
    slices = _slices(n)
    plan = plan_parts(order, _block_distances(nodes, order), n, distance, slices)
    scan, schema = _verify(plan, distance, agree or 0, columns)
    edges = _dealt(nodes, slices, columns).mapInArrow(scan, schema)
    name = lambda side: F.col(f"fp_{side}") if agree is None else F.xxhash64(f"fp_{side}", f"check_{side}")
    linked = components(edges.select(name("a").alias("u"), name("b").alias("v")))
    own = F.col("fp") if agree is None else F.xxhash64("fp", "check")
    named = nodes.withColumn("node", own).join(linked, "node", "left")
    return prints.join(named.select(*columns, F.coalesce("component", "node").alias("component")), columns)


def near_duplicates(documents: DataFrame, shingle: int = 4, distance: int = 4, agree: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id that links reach), one row per document.

    Fingerprints link at ``distance`` or fewer differing bits; with ``agree``, only
    if at least so many of 64 min-hash bits are equal too (2 * agree / 64 - 1
    estimates the Jaccard similarity).
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    prints = checkpoint(fingerprints(docs, shingle, agree is not None))
    grouped = checkpoint(_components(prints, distance, agree))
    least = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return grouped.join(least, "component").select("doc_id", text.alias("fingerprint"), "component_id")


def one_of_each(documents: DataFrame, shingle: int = 5, least: float = 0.8, distance: int = 10) -> DataFrame:
    """The document with the least doc_id of each group of near duplicates, in the columns of ``documents``.

    SimHash fingerprints that links of ``distance`` or fewer differing bits connect are candidates, as are texts that
    share min-hash keys (:mod:`near_copies`). Of these, links are pairs whose shingle sets have a Jaccard similarity of ``least`` or more. Of rows that share that id the one with the least hash stays; a null id counts as the largest.
    """
    rows = neutral(documents, ["doc_id", "text"])
    rows = rows.withColumn("_key", F.xxhash64(*rows.columns))
    docs = rows.select(F.col("doc_id").alias("_id"), "_key", F.col("text").cast("string").alias("text"))
    order = F.struct(F.col("_id").isNull().alias("unknown"), F.col("_id").alias("id"), F.col("_key").alias("key"))
    near = checkpoint(_components(checkpoint(fingerprints(docs, shingle)), distance, None).select("_key", F.col("component").alias("near")))
    kept = similar_groups(docs, shingle, least, near).groupBy("component").agg(F.min(order).alias("_f"))
    kept = kept.select(F.col("_f.id").alias("_kept_id"), F.col("_f.key").alias("_kept_key"))
    found = rows.join(kept, (F.col("_key") == F.col("_kept_key")) & F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")
    return restored(found.dropDuplicates(["_key", "doc_id"]), documents, ["doc_id", "text"])
