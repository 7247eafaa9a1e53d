"""Mixing sources to target weights, in blocks of words, by DataFrame expressions only.

* The words of a source, document after document, are packed into blocks of
  ``block`` words, or of a LEAST_BLOCKS-th of the source if that is less, so that small sources come near their targets too. A document's place comes from a two-level running sum, over
  about sqrt(n) buckets of about sqrt(n) documents, so no task holds a source.
* Targets: sources in ascending code-point order (null last) take the weights in
  turn and share ``share`` times all words, at most ``most`` times their own; the
  excess goes to the others by weight. A source's target fixes its number of slots.
* Each slot picks its output shard by hash: the source counts of a shard are
  multinomial draws, conditioned on the totals that the targets ask for.
* Slot i of a source stands for place i modulo the number of its blocks, in a
  pseudorandom permutation of them (a Feistel network that walks its cycles),
  one permutation per pass. So no block is taken more than ``most`` times.
* Slots and blocks are joined by block index. :func:`write_shards` stores the blocks by
  shard, :func:`shard_counts` counts them.

Everything depends on hashes of the rows, the seed and the parameters, so reruns agree.
Only per-source sums meet: three numbers per pass of the excess reach the driver.

Nulls: a null text has size 0, a null source is a source of its own, a null
doc_id is an id like others. Rows that are equal in all columns are counted and
told apart by number. A document without words is in no block and has taken 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.columns import neutral, restored
from tidemark.sources.durable import checkpoint

WORD = r"[^\x20\x09-\x0D]+"
KEEP = ("doc_id", "source", "text")
WEIGHTS = (5, 2, 1)
BLOCK = 64
LEAST_BLOCKS = 50
SHARD_SLOTS = 1 << 16
CHUNK_SLOTS = 4096
TASK_SLOTS = 1 << 21
ROUNDS = 3
# Walking back into the range: the slack is under sqrt(n), so n <= 1600 always ends, and for
# larger n the chance to need more steps is below 40 ** -40.
WALK = 40


@dataclass
class Mix:
    """docs: one row per document; sources: one per source; pieces: one per slot and document in its block."""

    docs: DataFrame
    sources: DataFrame
    pieces: DataFrame


def ranked(table: DataFrame, *order: Column) -> DataFrame:
    """Adds ``rank`` from 0 in ascending order, without gathering the rows in one task."""
    placed = checkpoint(
        table.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    parts = placed.groupBy("_part").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0))).select("_part", "_before")
    return placed.join(parts, "_part").withColumn("rank", F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def source_targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Adds ``target`` to (source, source_size, rank, ...) rows."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = checkpoint(sources.withColumn("_weight", weight))
    limit = most * F.col("source_size")
    whole = table.agg(F.sum("source_size").alias("n"), F.sum("_weight").alias("w")).first()
    wanted, level, stopped = share * (whole["n"] or 0), 0.0, -1
    if whole["w"]:
        level = wanted / whole["w"]
    while whole["w"]:
        above = F.col("_weight") * level >= limit
        now = table.agg(
            F.sum(F.when(above, limit).otherwise(0.0)).alias("full"), F.sum(F.when(above, 0.0).otherwise(F.col("_weight"))).alias("free"),
            F.sum(above.cast("long")).alias("n")).first()
        if now["n"] == stopped or not now["free"]:
            break
        level, stopped = (wanted - now["full"]) / now["free"], now["n"]
    return table.withColumn("target", F.least(limit, F.col("_weight") * level)).drop("_weight")


def _div(a: Column, b: Column | int) -> Column:
    return F.floor(a / b).cast("bigint")


def _shuffled(x: Column, rows: Column, columns: Column, seeds: tuple[Column, ...]) -> Column:
    """A permutation of 0 .. rows * columns - 1."""
    first = F.struct(_div(x, columns).alias("l"), (x % columns).alias("r"))

    def turn(s: Column, k: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(F.xxhash64(k, F.lit(0), s["r"], *seeds), rows), rows)
        right = lambda own: F.pmod(s["r"] + F.pmod(F.xxhash64(k, F.lit(1), own, *seeds), columns), columns)
        return F.struct(left.alias("l"), right(left).alias("r"))

    turned = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, turn)
    return turned["l"] * columns + turned["r"]


def permuted(x: Column, n: Column, *seeds: Column) -> Column:
    """Where the pseudorandom permutation of 0 .. n - 1 sends x."""
    rows = F.ceil(F.sqrt(n)).cast("bigint")
    columns = F.ceil(n / rows).cast("bigint")
    step = lambda at: _shuffled(at, rows, columns, seeds)
    walk = lambda at: F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), at, lambda x, _: F.when(x < n, x).otherwise(step(x)))
    # Nearly all first steps end in the range; the array binds that step's result, so that it is computed once.
    return F.element_at(F.transform(F.array(step(x)), lambda at: F.when(at < n, at).otherwise(walk(at))), 1)


def mix_sources(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0,
    block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 0,
) -> Mix:
    """Plans the mix of all documents (doc_id, text, source; other columns only tell rows apart)."""
    spark = documents.sparkSession
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), row_key(documents).alias("key"), size.alias("size"))
    docs = checkpoint(
        rows.groupBy("doc_id", "source", "key", "size").agg(F.count(F.lit(1)).alias("_n"))
        .select("doc_id", "source", "key", "size", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("nth")))
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    sources = source_targets(ranked(sources, F.col("source").asc_nulls_last()), weights, share, most)
    blocks = F.ceil(F.col("source_size") / F.col("width")).cast("bigint")
    passes = F.when(F.col("source_size") > 0, _div(F.col("target"), F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - passes * F.col("source_size")
    sources = checkpoint(
        sources.withColumn("width", F.greatest(F.lit(1), F.least(F.lit(block), _div(F.col("source_size"), LEAST_BLOCKS))).cast("bigint"))
        .withColumn("blocks", blocks)
        .withColumn("slots", passes * F.col("blocks") + F.least(F.round(rest / F.col("width")).cast("bigint"), F.col("blocks")))
        .withColumn("_buckets", F.ceil(F.sqrt("_docs")).cast("int")))
    total = sources.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-int(total) // shard_slots))

    # Place of each document in its source.
    same = docs["source"].eqNullSafe(sources["source"])
    placed = docs.join(sources.select("source", "rank", "width", "_buckets"), same).drop(sources["source"])
    placed = placed.filter("size > 0").withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "key", "nth", F.lit(seed)), F.col("_buckets")))
    run = Window.partitionBy("rank", "_bucket").orderBy("doc_id", "key", "nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = checkpoint(placed.withColumn("_in", F.coalesce(F.sum("size").over(run), F.lit(0))))
    ahead = Window.partitionBy("rank").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("rank", "_bucket").agg(F.sum("size").alias("_sum"))
    starts = starts.withColumn("_before", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).select("rank", "_bucket", "_before")
    start = F.col("_before") + F.col("_in")
    placed = placed.join(starts, ["rank", "_bucket"]).withColumn("_start", start)
    cut = placed.withColumn("block", F.explode(F.sequence(_div(F.col("_start"), F.col("width")), _div(F.col("_start") + F.col("size") - 1, F.col("width")))))
    low, high = F.greatest(F.col("block") * F.col("width"), "_start"), F.least((F.col("block") + 1) * F.col("width"), F.col("_start") + F.col("size"))
    parts = cut.select(
        "rank", "block", "doc_id", "source", "key", "nth", "size", (low - F.col("_start")).alias("start"), (high - F.col("_start")).alias("end"))

    # Slots, made in chunks so that a hot source is spread.
    chunks = sources.filter("slots > 0").select(
        "rank", "slots", "blocks", F.explode(F.sequence(F.lit(0).cast("bigint"), _div(F.col("slots") - 1, CHUNK_SLOTS))).alias("_chunk"))
    # A fixed number of tasks: adaptive execution would judge the chunks by their size before they are exploded.
    chunks = chunks.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // TASK_SLOTS)), "rank", "_chunk")
    ends = F.least((F.col("_chunk") + 1) * CHUNK_SLOTS, F.col("slots")) - 1
    slots = chunks.select("rank", "blocks", F.explode(F.sequence(F.col("_chunk") * CHUNK_SLOTS, ends)).alias("slot"))
    turn = _div(F.col("slot"), F.col("blocks"))
    slots = slots.select(
        "rank", "slot", turn.alias("turn"), F.pmod(F.xxhash64(F.lit(seed), "rank", "slot"), F.lit(shards)).alias("shard"),
        permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("rank"), turn).alias("block"))
    # Both sides grow with the corpus, more than estimates across an explode say: never a broadcast.
    pieces = checkpoint(slots).join(parts.hint("merge"), ["rank", "block"]).select(
        "shard", "rank", "slot", "turn", "block", "doc_id", "source", "key", "nth", "size", "start", "end")
    return Mix(docs, sources.drop("width", "_docs", "_buckets"), pieces)


def row_key(documents: DataFrame) -> Column:
    """A hash of the whole row."""
    return F.xxhash64(*[documents[c] for c in documents.columns])


def taken_words(documents: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    mix = mix_sources(neutral(documents, KEEP), **how)
    taken = mix.pieces.groupBy("doc_id", "source", "key", "nth").agg(F.sum(F.col("end") - F.col("start")).alias("taken"))
    names = ["doc_id", "source", "key", "nth"]
    own = mix.docs.join(mix.sources.select(F.col("source").alias("_source"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_source")))
    taken = taken.select(*[F.col(c).alias(f"_t_{c}") for c in names], "taken")
    match = F.lit(True)
    for c in names:
        match = match & (F.col(c) == F.col(f"_t_{c}") if c in ("key", "nth") else F.col(c).eqNullSafe(F.col(f"_t_{c}")))
    return own.join(taken, match, "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def shard_counts(mix: Mix) -> DataFrame:
    """How many slots and words of each source each output shard has: shard, source, n_slots, n_words."""
    counts = mix.pieces.groupBy("shard", "rank").agg(F.count_distinct("slot").alias("n_slots"), F.sum(F.col("end") - F.col("start")).alias("n_words"))
    return counts.join(mix.sources.select("rank", "source"), "rank").select("shard", "source", "n_slots", "n_words")


def shard_blocks(documents: DataFrame, **how) -> DataFrame:
    """The mix as it is trained on: shard, place (a pseudorandom order in the shard), source, slot, block, text of the block.

    Pieces are gathered by document, so that each text moves and is split once, and then by block. Documents of a block
    stand in ascending order of doc_id (null first), their words in theirs.
    """
    rows = neutral(documents, KEEP)
    mix = mix_sources(rows, **how)
    piece = F.struct("shard", "rank", "slot", "block", "nth", "start", "end")
    takes = mix.pieces.groupBy("doc_id", "key").agg(F.collect_list(piece).alias("_pieces"))
    takes = takes.select(F.col("doc_id").alias("_take_id"), F.col("key").alias("_take_key"), "_pieces")
    one = rows.withColumn("_key", row_key(rows)).dropDuplicates(["doc_id", "_key"])
    joined = one.join(takes, F.col("doc_id").eqNullSafe(F.col("_take_id")) & (F.col("_key") == F.col("_take_key")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The words are split once per row, whatever the number of pieces.
    cut = F.element_at(F.transform(F.array(words), lambda ws: F.transform("_pieces", lambda p: F.struct(
        p["shard"].alias("shard"), p["rank"].alias("rank"), p["slot"].alias("slot"), p["block"].alias("block"), p["nth"].alias("nth"), p["start"].alias("start"),
        F.array_join(F.slice(ws, (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int")), " ").alias("part")))), 1)
    parts = joined.select("doc_id", "_key", F.explode(cut).alias("_p")).select("doc_id", "_key", "_p.*")
    ordered = F.array_sort(F.collect_list(F.struct("doc_id", "_key", "nth", "start", "part")))
    blocks = parts.groupBy("shard", "rank", "slot", "block").agg(F.array_join(F.transform(ordered, lambda p: p["part"]), " ").alias("text"))
    place = F.xxhash64(F.lit(how.get("seed", 0)), F.lit("place"), "rank", "slot")
    return blocks.join(mix.sources.select("rank", "source"), "rank").select("shard", place.alias("place"), "source", "slot", "block", "text")


def write_shards(documents: DataFrame, path: str, **how) -> None:
    """Writes the blocks of each shard in their order, one folder ``shard=...`` each; a shard has some ``shard_slots`` blocks."""
    blocks = shard_blocks(documents, **how)
    blocks.repartition("shard").sortWithinPartitions("shard", "place", "source", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)


def mixed_documents(documents: DataFrame, **how) -> DataFrame:
    """The mix as documents: one row per document and pass that takes words of it, in the columns of ``documents``.

    A document taken whole keeps its text; otherwise its taken words, in order,
    are joined by a space. A column n_chars is set to the length of the text.
    """
    rows = neutral(documents, KEEP)
    mix = mix_sources(rows, **how)
    spans = mix.pieces.groupBy("doc_id", "key", "nth", "turn").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"), F.sum(F.col("end") - F.col("start")).alias("_taken"), F.first("size").alias("_size"))
    takes = spans.groupBy("doc_id", "key").agg(F.collect_list(F.struct("_spans", "_taken", "_size")).alias("_takes"))
    takes = takes.select(F.col("doc_id").alias("_take_id"), F.col("key").alias("_take_key"), "_takes")
    one = rows.withColumn("_key", row_key(rows)).dropDuplicates(["doc_id", "_key"])
    joined = one.join(takes, F.col("doc_id").eqNullSafe(F.col("_take_id")) & (F.col("_key") == F.col("_take_key"))).withColumn("_take", F.explode("_takes"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The words are split once per row, whatever the number of spans.
    part = F.element_at(F.transform(F.array(words), lambda ws: F.array_join(F.flatten(F.transform(
        "_take._spans", lambda s: F.slice(ws, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), " ")), 1)
    text = F.when(F.col("_take._taken") == F.col("_take._size"), F.col("text")).otherwise(part)
    out = restored(joined.withColumn("text", text), documents, KEEP)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out
