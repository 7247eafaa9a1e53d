"""Groups of texts whose word-shingle sets have a Jaccard similarity of ``least`` or more, decided on the sets.

* Candidates: BANDS keys of ROWS min-hashes each. A pair of similarity s shares a key
  with probability 1 - (1 - s**ROWS)**BANDS: 0.9993 at 0.8. Texts that share a
  key are joined to the least of them, never to each other, and the connected
  components are the candidates. Texts with equal sets are one node from the start.
* Candidates found by other means, such as fingerprints, come in as further keys.
* Verification: all pairs inside a component are compared on their shingle sets, so a
  pair is missed only where no chain of keys connects it, and none below ``least`` is
  linked. Pairs that links already connect need no comparison.
* Chance links of fingerprints join ever more texts as their number grows. A component above
  SPLIT * CHUNK nodes is therefore cut first: two sets of similarity ``least`` share one of the
  first shingles of each, as many as may be missing and one more, in any order that is the same for all. Rare
  ones come first, by counts of 1 / COUNTED of all. Texts that no chain of such shingles connects are not similar.
* A component above CHUNK nodes is dealt over chunks by hash, and its first node goes to
  each of them. What links connect to that node is one group over all chunks;
  only the other nodes are sent to every chunk for the pairs between chunks.

The links of a chunk leave as a spanning forest. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import LOWER, PLAIN_WORD, Hasher, find_words, mix, text_chunks
from tidemark.operators.components import components
from tidemark.sources.durable import checkpoint

BANDS, ROWS = 24, 6
CHUNK = 128
SPLIT = 8
COUNTED = 1 << 16
_U = np.uint64
_CHUNK_BYTES = 1 << 18


def _shingles(hasher: Hasher, data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and how many each text has; a shorter text is one shingle."""
    lowered = LOWER[data]
    starts, ends, first = find_words(lowered, offsets, PLAIN_WORD)
    words = hasher.words(lowered, starts, ends)
    many = np.diff(first)
    count = np.where(many == 0, 0, np.maximum(many - shingle + 1, 1))
    of = np.repeat(np.arange(len(many)), count)
    left = first[:-1][of] + np.arange(len(of)) - (np.cumsum(count) - count)[of]
    width = np.minimum(many, shingle)[of]
    hashes = np.zeros(len(of), _U)
    for k in np.unique(width).tolist():
        own = width == k
        hashes[own] = hasher.runs(words, k)[left[own]]
    return hashes, count


def _band_keys(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One row of BANDS keys for each run of hashes."""
    rng = np.random.Generator(np.random.PCG64(17))
    factors = rng.integers(0, 2**64, BANDS * ROWS, dtype=_U) | _U(1)
    adds = rng.integers(0, 2**64, BANDS * ROWS, dtype=_U)
    keys = np.tile(np.arange(BANDS, dtype=_U), (len(begin), 1))
    for k in range(BANDS * ROWS):
        least = np.minimum.reduceat(hashes * factors[k] + adds[k], begin)
        keys[:, k // ROWS] = mix(keys[:, k // ROWS] * _U(0x9E3779B97F4A7C15) + least)
    return keys


def _scanned(documents: DataFrame, shingle: int, with_set: bool) -> DataFrame:
    """``text``, the last column, replaced by the node and its band keys, or by the sorted shingle set."""
    rest = documents.columns[:-1]
    added = ["members"] if with_set else ["node", "bands"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(len(rest)), _CHUNK_BYTES):
                hashes, count = _shingles(hasher, data, offsets, shingle)
                ends = np.cumsum(count)
                sets = [np.unique(hashes[b - n:b]) for b, n in zip(ends.tolist(), count.tolist())]
                columns = [c.slice(i, j - i) for c in batch.columns[:len(rest)]]
                if with_set:
                    flat = np.concatenate(sets).view(np.int64)
                    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)))
                else:
                    full = np.flatnonzero(count)
                    keys = _band_keys(hashes, (ends - count)[full]) if len(full) else np.zeros((0, BANDS), _U)
                    bounds = np.concatenate([[0], np.cumsum(np.where(count > 0, BANDS, 0))]).astype(np.int32)
                    columns.append(pa.array(np.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], _U).view(np.int64)))
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.ravel().view(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, [*rest, *added])

    types = ["members array<bigint>"] if with_set else ["node bigint", "bands array<bigint>"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*rest).schema.fields]
    return documents.mapInArrow(scan, ", ".join(fields + types))


def _linked(flat: np.ndarray, bounds: np.ndarray, label: np.ndarray, home: np.ndarray, across: bool, least: float):
    """Labels after linking all pairs (``across``: those of a home row and another) and the forest of new links, as row pairs."""
    size, label = np.diff(bounds), label.copy()
    names, codes = np.unique(flat, return_inverse=True)
    mark = np.zeros(len(names), bool)
    a, b = [], []
    for p in range(len(label) - 1):
        other = (label != label[p]) & (np.minimum(size, size[p]) >= least * np.maximum(size, size[p]) - 1e-9)
        other[:p + 1] = False
        if across:
            other &= home != home[p]
        if not other.any():
            continue
        own = codes[bounds[p]:bounds[p + 1]]
        mark[own] = True
        shared = np.add.reduceat(mark[codes], bounds[:-1], dtype=np.int64)
        mark[own] = False
        for q in np.flatnonzero(other & (shared >= least * (size + size[p] - shared) - 1e-9)).tolist():
            if label[q] != label[p]:
                a.append(p)
                b.append(q)
                label[label == label[q]] = label[p]
    return label, a, b


def _chunk_links(across: bool, least: float):
    """Links (u, v) of chunks of rows sorted by component and chunk; without ``across`` also, as (node, null), the nodes that no link ties to the first."""
    def group_links(component, node, label, home, flat, bounds):
        out, a, b = _linked(flat, bounds, label, home, across, least)
        us, vs = node[a].tolist(), node[b].tolist()
        if not across:
            loose = node[home & (out != out[np.flatnonzero(node == component)[0]])].tolist()
            us, vs = us + loose, vs + [None] * len(loose)
        return us, vs

    def links_of(table: pa.Table) -> pa.RecordBatch:
        component, chunk, node, label, home = (table.column(c).to_numpy(zero_copy_only=False) for c in ("component", "chunk", "node", "label", "home"))
        members = table.column("members").combine_chunks()
        members = members if isinstance(members, pa.ListArray) else pa.concat_arrays(members.chunks)
        bounds, flat = members.offsets.to_numpy(), members.values.to_numpy(zero_copy_only=False)
        begin = np.flatnonzero(np.append(True, (component[1:] != component[:-1]) | (chunk[1:] != chunk[:-1]))).tolist()
        us, vs = [], []
        for i, j in zip(begin, begin[1:] + [len(node)]):
            if j - i > 1 or not across:
                u, v = group_links(component[i], node[i:j], label[i:j], home[i:j], flat[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
                us += u
                vs += v
        return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if not held.num_rows:
                continue
            component, chunk = (held.column(c).to_numpy() for c in ("component", "chunk"))
            done = np.flatnonzero((component != component[-1]) | (chunk != chunk[-1]))
            if len(done):
                cut = int(done[-1]) + 1
                yield links_of(held.slice(0, cut).combine_chunks())
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield links_of(held.combine_chunks())

    return scan


def _in_chunks(placed: DataFrame, across: bool, least: float) -> DataFrame:
    rows = placed.select("component", "chunk", "node", "label", "home", "members")
    return rows.repartition("component", "chunk").sortWithinPartitions("component", "chunk").mapInArrow(_chunk_links(across, least), "u bigint, v bigint")


def candidate_components(prints: DataFrame, keys: DataFrame) -> DataFrame:
    """(node, component) of all nodes that a chain of shared band keys, or of other shared ``keys`` (node, band), connects to another; component = least node."""
    keyed = prints.dropDuplicates(["node"]).select("node", F.explode("bands").alias("band")).union(keys.select("node", "band").distinct())
    first = keyed.groupBy("band").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "first")
    return components(keyed.join(first, "band").select(F.col("node").alias("u"), F.col("first").alias("v")))


def _counter(members: np.ndarray) -> np.ndarray:
    """Which of the COUNTED counters a shingle has."""
    return (mix(members.view(_U)) >> _U(48)).astype(np.int64) % COUNTED


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All members one after the other, and where each list ends."""
    bounds = lists.offsets.to_numpy()
    return lists.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]], bounds - bounds[0]


def _counts(sets: DataFrame) -> np.ndarray:
    """How many members each counter has."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTED, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_counter(_flat(batch.column(0))[0]), minlength=COUNTED)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    out = np.zeros(COUNTED, np.int64)
    for row in sets.select("members").mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[row["at"]] = row["n"]
    return out


def _first_shingles(sets: DataFrame, least: float) -> DataFrame:
    """(component, node, token): the rarest members of each set, of which two similar sets share at least one."""
    counts = _counts(sets)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, bounds = _flat(batch.column(2))
            size = np.diff(bounds)
            of = np.repeat(np.arange(len(size)), size)
            order = np.lexsort([flat, counts[_counter(flat)], of])
            needed = np.where(size > 0, size - np.ceil(least * size - 1e-6).astype(np.int64) + 1, 0)
            taken = order[np.arange(len(flat)) - bounds[:-1][of] < needed[of]]
            rows = pa.array(of[taken])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(flat[taken])], ["component", "node", "token"])

    return sets.select("component", "node", "members").mapInArrow(scan, "component bigint, node bigint, token bigint")


def _cut(sets: DataFrame, least: float) -> DataFrame:
    """``sets`` of large components under smaller ones, which hold all similar pairs; nodes that are similar to no other may be left out."""
    tokens = checkpoint(_first_shingles(sets, least))
    first = tokens.groupBy("component", "token").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    found = components(tokens.join(first, ["component", "token"]).select(F.col("node").alias("u"), F.col("first").alias("v")))
    return sets.drop("component", "chunks", "chunk").join(_chunked(found), "node").select(*sets.columns)


def _chunked(found: DataFrame) -> DataFrame:
    sizes = found.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    return found.join(sizes, "component").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))


def similar_groups(documents: DataFrame, shingle: int, least: float, near: DataFrame) -> DataFrame:
    """``documents`` (last columns _key, text) without text, with ``component``: a number shared by all rows that links connect.

    ``near`` (_key, near) names candidates found otherwise: rows that share a ``near`` are compared like those that share a band key.
    """
    prints = checkpoint(_scanned(documents, shingle, False))
    keys = prints.select("node", "_key").join(near, "_key").select("node", F.xxhash64(F.lit("near"), "near").alias("band"))
    found = checkpoint(candidate_components(prints.select("node", "bands"), keys))
    found = _chunked(found)
    chosen = prints.select("node", "_key").groupBy("node").agg(F.min("_key").alias("_key")).join(found, "node")
    texts = documents.select("_key", "text").join(chosen, "_key").dropDuplicates(["node"])
    sets = checkpoint(_scanned(texts.select("component", "chunks", "chunk", "node", "text"), shingle, True))
    large = sets.filter(F.col("chunks") > SPLIT)
    if not large.isEmpty():
        sets = checkpoint(sets.filter(F.col("chunks") <= SPLIT).union(_cut(large, least)))

    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    places = F.when(F.col("node") == F.col("component"), every).otherwise(F.array("chunk"))
    placed = sets.withColumn("label", F.col("node")).withColumn("to", F.explode(places))
    inside = checkpoint(_in_chunks(placed.withColumn("home", F.col("to") == F.col("chunk")).drop("chunk").withColumnRenamed("to", "chunk"), False, least))
    links = inside.filter("v IS NOT NULL")

    # Between chunks: the nodes that are not tied to the first one meet all others.
    loose = inside.filter("v IS NULL").select(F.col("u").alias("node"), F.lit(True).alias("loose"))
    many = sets.filter("chunks > 1").join(loose, "node", "left").withColumn("label", F.when(F.col("loose"), F.col("node")).otherwise(F.col("component")))
    many = many.withColumn("to", F.explode(F.when(F.col("loose"), every).otherwise(F.array("chunk"))))
    many = many.withColumn("home", F.col("to") == F.col("chunk")).drop("chunk").withColumnRenamed("to", "chunk")
    grouped = components(links.union(_in_chunks(many, True, least)))
    return prints.drop("bands").join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("node")
