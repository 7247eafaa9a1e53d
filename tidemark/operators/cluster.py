"""DBSCAN of positions per track, without comparing all pairs.

Points are put into square cells whose diagonal is just under eps, so points of
one cell are always neighbours:

* a cell with at least ``min_points`` rows is dense and all its points are core;
* any other cell has fewer than ``min_points`` rows, so counting the neighbours
  of its points needs only that many comparisons per point of a nearby cell;
* two cells with core points belong together if some core pair is within eps.
  Bounding boxes settle most of these. For the rest only the outermost point per
  coordinate line on the facing sides is compared, which is exact, because a
  point further in on the same line is further away from every point across.

Equal coordinates are merged first. The work therefore follows the number of
cells and their outlines, however many rows one anchorage collects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import constants as K
from tidemark.operators.components import components
from tidemark.operators.lookup import lookup_join
from tidemark.sources.durable import checkpoint

NOISE = -1
#: Cell side as a share of eps; below 1/sqrt(2), so a cell's diagonal stays under eps.
SIDE = 0.7071
REACH = 2
#: Cells along the side of a block.
BLOCK = 8


def track_eps(direction: str = "dir", ts: str = "dt_pos_utc") -> Column:
    """eps of a track from the direction of its first row (an aggregate)."""
    first = F.min_by(F.col(direction), F.col(ts))
    return F.when(first == "South", F.lit(K.DBSCAN_EPS_SOUTH)).otherwise(F.lit(K.DBSCAN_EPS_OTHER))


def _near(ax: Column, ay: Column, bx: Column, by: Column, eps: Column) -> Column:
    return (ax - bx) * (ax - bx) + (ay - by) * (ay - by) <= eps * eps


def _near_cells(cells: DataFrame, key: list[str]) -> DataFrame:
    """(hx, hy, cx, cy): each cell of a track with the occupied cells within reach, its own included.

    Cells meet in blocks: a cell goes to the blocks that its reach touches, 2.25 on average, so a block holds at most
    (BLOCK + 2 * REACH)^2 of them, and cells with nothing around them are not repeated for every place around.
    """
    def touched(c: str) -> Column:
        return F.explode(F.sequence(F.floor((F.col(c) - REACH) / BLOCK), F.floor((F.col(c) + REACH) / BLOCK)))

    dealt = cells.select(*key, "cx", "cy").distinct().withColumn("_bx", touched("cx")).withColumn("_by", touched("cy"))
    blocks = dealt.groupBy(*key, "_bx", "_by").agg(F.collect_list(F.struct("cx", "cy")).alias("_all"))
    own = F.filter("_all", lambda c: (F.floor(c["cx"] / BLOCK) == F.col("_bx")) & (F.floor(c["cy"] / BLOCK) == F.col("_by")))
    homes = blocks.select(*key, "_all", F.explode(own).alias("_h"))
    near = F.filter("_all", lambda c: (F.abs(c["cx"] - F.col("_h.cx")) <= REACH) & (F.abs(c["cy"] - F.col("_h.cy")) <= REACH))
    pairs = homes.select(*key, F.col("_h.cx").alias("hx"), F.col("_h.cy").alias("hy"), F.explode(near).alias("_c"))
    return pairs.select(*key, "hx", "hy", "_c.cx", "_c.cy")


def _around(df: DataFrame, near: DataFrame, key: list[str], include_own: bool) -> DataFrame:
    """Repeat each row for the occupied cells within reach, as (cx, cy); its own cell stays in (hx, hy)."""
    if not include_own:
        near = near.filter("cx != hx OR cy != hy")
    return df.withColumnRenamed("cx", "hx").withColumnRenamed("cy", "hy").join(near, [*key, "hx", "hy"])


def dbscan(
    points: DataFrame,
    key: Sequence[str],
    order: str,
    x: str = "longitude",
    y: str = "latitude",
    eps: str = "eps",
    min_points: int = K.DBSCAN_MIN_POINTS,
) -> DataFrame:
    """Add ``cluster``: 0, 1, ... per track by first core row in ``order``, -1 for noise.

    ``eps`` is a column with one value per track and ``order`` a long column
    that is unique in the track. A border point takes the lowest cluster in reach.
    """
    key = list(key)
    cell = [*key, "cx", "cy"]
    side = F.col("_e") * F.lit(SIDE)
    spots = points.select(*key, F.col(x).alias("_x"), F.col(y).alias("_y"), F.col(eps).alias("_e"), F.col(order).alias("_o"))
    spots = spots.groupBy(*key, "_x", "_y").agg(
        F.min("_e").alias("_e"), F.count(F.lit(1)).alias("_w"), F.min("_o").alias("_o")
    )
    spots = spots.withColumn("cx", F.floor(F.col("_x") / side)).withColumn("cy", F.floor(F.col("_y") / side))
    weights = spots.groupBy(*cell).agg(F.sum("_w").alias("_cw"))
    spots = checkpoint(lookup_join(spots, weights, cell, grows=True))

    near = checkpoint(_near_cells(spots, key))
    dense, sparse = spots.filter(F.col("_cw") >= min_points), spots.filter(F.col("_cw") < min_points)

    # Core points of sparse cells: own cell's weight plus neighbours within eps.
    probes = _around(sparse.select(*cell, F.col("_x").alias("px"), F.col("_y").alias("py"), F.col("_cw").alias("own")), near, key, False)
    seen = lookup_join(spots, probes, cell, grows=True)
    seen = seen.filter(_near(F.col("px"), F.col("py"), F.col("_x"), F.col("_y"), F.col("_e")))
    found = seen.groupBy(*key, "px", "py").agg((F.sum("_w") + F.first("own")).alias("_n")).filter(F.col("_n") >= min_points)
    found = found.select(*key, F.col("px").alias("_x"), F.col("py").alias("_y"))
    sparse_core = sparse.join(found, [*key, "_x", "_y"], "left_semi")
    core = checkpoint(dense.unionByName(sparse_core))

    # A node per cell with core points, named after the earliest of them.
    nodes = core.groupBy(*cell).agg(
        F.min("_e").alias("_e"), F.min("_o").alias("_first"),
        F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1"),
    )
    nodes = checkpoint(nodes.withColumn("node", F.col("_first")))
    links = _cell_links(core, nodes, near, key)
    named = _components_by_track(nodes, links, key)

    labelled = lookup_join(core, named, cell, grows=True)
    labels = labelled.select(*key, "_x", "_y", "cluster")
    # Border points: non-core points with a core point within eps.
    rest = sparse.join(found, [*key, "_x", "_y"], "left_anti")
    probes = _around(rest.select(*cell, F.col("_x").alias("px"), F.col("_y").alias("py")), near, key, True)
    touched = lookup_join(labelled, probes, cell, grows=True)
    touched = touched.filter(_near(F.col("px"), F.col("py"), F.col("_x"), F.col("_y"), F.col("_e")))
    border = touched.groupBy(*key, "px", "py").agg(F.min("cluster").alias("cluster"))
    border = border.select(*key, F.col("px").alias("_x"), F.col("py").alias("_y"), "cluster")
    labels = labels.unionByName(border)

    out = points.withColumn("_x", F.col(x)).withColumn("_y", F.col(y))
    out = lookup_join(out, labels, [*key, "_x", "_y"], "left", grows=True)
    return out.withColumn("cluster", F.coalesce(F.col("cluster"), F.lit(NOISE))).drop("_x", "_y")


def _cell_links(core: DataFrame, nodes: DataFrame, near: DataFrame, key: list[str]) -> DataFrame:
    """Pairs (a, b) of core cells of one track with a core pair within eps."""
    cell = [*key, "cx", "cy"]
    box = ["x0", "x1", "y0", "y1"]
    other = nodes.select(*cell, F.col("node").alias("b"), *[F.col(c).alias(f"b_{c}") for c in box])
    pairs = _around(nodes, near, key, False).join(other, cell)
    # Each unordered pair once: the second cell lies to the right, or straight above.
    right = F.col("cx") > F.col("hx")
    above = (F.col("cx") == F.col("hx")) & (F.col("cy") > F.col("hy"))
    pairs = pairs.filter(right | above).withColumn("sideways", right)

    def apart(lo: str, hi: str) -> Column:
        return F.greatest(F.col(f"b_{lo}") - F.col(hi), F.col(lo) - F.col(f"b_{hi}"), F.lit(0.0))

    def across(lo: str, hi: str) -> Column:
        return F.greatest(F.col(f"b_{hi}") - F.col(lo), F.col(hi) - F.col(f"b_{lo}"))

    limit = F.col("_e") * F.col("_e")
    nearest = F.pow(apart("x0", "x1"), F.lit(2.0)) + F.pow(apart("y0", "y1"), F.lit(2.0))
    farthest = F.pow(across("x0", "x1"), F.lit(2.0)) + F.pow(across("y0", "y1"), F.lit(2.0))
    # The slack leaves pairs at exactly eps to the exact comparison.
    pairs = pairs.filter(nearest <= limit * (1 + 1e-9)).withColumn("sure", farthest <= limit * (1 - 1e-9))
    pairs = checkpoint(pairs.select(
        *key, F.col("node").alias("a"), "b", "_e", "sideways", "sure",
        *box, *[f"b_{c}" for c in box],
    ))
    sure = pairs.filter("sure").select(*key, "a", "b")

    open_pairs = pairs.filter("NOT sure")
    tagged = lookup_join(core, nodes.select(*cell, "node"), cell, grows=True).select(*key, "node", "_x", "_y")
    outer_a = _facing(tagged, open_pairs, key, "a", F.max, "b_")
    outer_b = _facing(tagged, open_pairs, key, "b", F.min, "")
    tested = outer_a.join(outer_b, [*key, "a", "b"])
    met = tested.filter(_near(F.col("a_x"), F.col("a_y"), F.col("b_x"), F.col("b_y"), F.col("a_e")))
    return sure.union(met.select(*key, "a", "b").distinct())


def _facing(tagged: DataFrame, pairs: DataFrame, key: list[str], who: str, pick, facing_box: str) -> DataFrame:
    """Outermost points of cell ``who`` towards its partner that could reach the partner's box."""
    sides = pairs.select(
        *key, "a", "b", "_e", "sideways", F.col(who).alias("node"),
        *[F.col(f"{facing_box}{c}").alias(f"_{c}") for c in ("x0", "x1", "y0", "y1")],
    )
    rows = lookup_join(tagged, sides, [*key, "node"], grows=True)
    dx = F.greatest(F.col("_x0") - F.col("_x"), F.col("_x") - F.col("_x1"), F.lit(0.0))
    dy = F.greatest(F.col("_y0") - F.col("_y"), F.col("_y") - F.col("_y1"), F.lit(0.0))
    rows = rows.filter(dx * dx + dy * dy <= F.col("_e") * F.col("_e") * (1 + 1e-9))
    line = F.when(F.col("sideways"), F.col("_y")).otherwise(F.col("_x"))
    depth = F.when(F.col("sideways"), F.col("_x")).otherwise(F.col("_y"))
    outer = rows.groupBy(*key, "a", "b", "sideways", line.alias("_line")).agg(
        pick(depth).alias("_depth"), F.min("_e").alias("_e")
    )
    return outer.select(
        *key, "a", "b",
        F.when(F.col("sideways"), F.col("_depth")).otherwise(F.col("_line")).alias(f"{who}_x"),
        F.when(F.col("sideways"), F.col("_line")).otherwise(F.col("_depth")).alias(f"{who}_y"),
        F.col("_e").alias(f"{who}_e"),
    )


def _components_by_track(nodes: DataFrame, links: DataFrame, key: list[str]) -> DataFrame:
    """Cluster number of every core cell, counted from 0 per track by first core row."""
    ids = nodes.select(*key, "node", "cx", "cy", "_first", F.monotonically_increasing_id().alias("id"))
    ids = checkpoint(ids)
    ends = ids.select(*key, "node", "id")
    edges = (
        links.join(ends.select(*key, F.col("node").alias("a"), F.col("id").alias("u")), [*key, "a"])
        .join(ends.select(*key, F.col("node").alias("b"), F.col("id").alias("v")), [*key, "b"])
        .select("u", "v")
    )
    joined = ids.join(components(edges).withColumnRenamed("node", "id"), "id", "left")
    joined = joined.withColumn("component", F.coalesce("component", "id"))
    first = joined.groupBy(*key, "component").agg(F.min("_first").alias("_first"))
    ranked = first.withColumn("cluster", F.row_number().over(Window.partitionBy(*key).orderBy("_first")) - 1)
    return joined.join(ranked.select(*key, "component", "cluster"), [*key, "component"]).select(*key, "cx", "cy", "cluster")
