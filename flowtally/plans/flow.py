"""Weighted flow graph of routes: links, nodes, levels, positions, offsets and adjacency.

`links(source, target, value, position)` with an integer position that orders them. Names
of nodes are never NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import lenient_sum
from ..operators.joins import join_on
from ..operators.ordered import EXACT, chunked, number_rows, running_total
from ..session import staged

SWEEPS = 32
COOLING = 0.99  # each sweep moves nodes by this much less


def links_from_routes(ranked: DataFrame) -> DataFrame:
    """Links from ranked top routes, in the order of `rank_origin` and `rank_dest`."""
    position = F.col("rank_origin").cast("long") * F.lit(1 << 31) + F.col("rank_dest")
    return ranked.select(
        F.col("origin").alias("source"),
        F.col("dest").alias("target"),
        F.col("n").cast("double").alias("value"),
        position.cast("long").alias("position"),
    )


def nodes(links: DataFrame) -> DataFrame:
    """name, node: distinct ends of the links, numbered from 0 by first use."""
    ends = F.array(
        F.struct(F.col("source").alias("name"), (F.col("position") * 2).alias("used")),
        F.struct(F.col("target").alias("name"), (F.col("position") * 2 + 1).alias("used")),
    )
    first = staged(links.select(F.inline(ends)).groupBy("name").agg(F.min("used").alias("used")), "flow-nodes")
    numbered = number_rows(first, "node", ["used"])
    return numbered.select("name", (F.col("node") - 1).alias("node"))


def indexed_links(links: DataFrame, numbered: DataFrame) -> DataFrame:
    """Links with node numbers in place of names."""
    source = numbered.select(F.col("name").alias("source"), F.col("node").alias("source_node"))
    target = numbered.select(F.col("name").alias("target"), F.col("node").alias("target_node"))
    return links.join(source, "source").join(target, "target").select("position", "source_node", "target_node", "value")


def throughput(links: DataFrame) -> DataFrame:
    """name, value: the larger of what leaves a node and what enters it."""
    ends = F.array(
        F.struct(F.col("source").alias("name"), F.col("value").alias("out"), F.lit(0.0).alias("into")),
        F.struct(F.col("target").alias("name"), F.lit(0.0).alias("out"), F.col("value").alias("into")),
    )
    sums = links.select(F.inline(ends)).groupBy("name").agg(lenient_sum("out").alias("out"), lenient_sum("into").alias("into"))
    return sums.select("name", F.greatest("out", "into").alias("value"))


def _jumped(pointers: DataFrame, count: int) -> DataFrame:
    """Follow (name -> up, dist) until `up` is no pointer itself: the steps double each time."""
    for _ in range(count.bit_length() + 1):
        ahead = pointers.select(F.col("name").alias("up"), F.col("up").alias("further"), F.col("dist").alias("more"), F.lit(True).alias("known"))
        found = join_on(pointers, ahead, "up", null_safe=False)
        moved = F.col("known").isNotNull()
        pointers = staged(
            found.select(
                "name",
                F.when(moved, F.col("further")).otherwise(F.col("up")).alias("up"),
                (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"),
                moved.alias("moved"),
            ),
            "flow-pointers",
        )
        if pointers.where("moved").isEmpty():
            return pointers.drop("moved")
        pointers = pointers.drop("moved")
    raise ValueError("the links form a cycle")


def node_levels(links: DataFrame) -> DataFrame:
    """name, level: longest path from a source; nodes without outgoing links on the last level.

    A node that only one link enters lies a known distance behind that link's source, so it
    is contracted: whole chains at once, by pointers whose steps double. Links that leave
    contracted nodes then start further up, those of equal ends merge into the longest, and
    more nodes have a single link. Sources count as entered from one common start. Rounds
    are written to the staging folder; where no node can be contracted, the links form a
    cycle: an error. A path of n links without side entrances takes about log2(n) steps.
    """
    pairs = staged(links.select("source", "target").distinct(), "flow-pairs")
    if pairs.isEmpty():
        return pairs.select(F.col("source").alias("name"), F.lit(0).alias("level"))
    targets = pairs.select(F.col("target").alias("source")).distinct()
    starts = join_on(pairs.select("source").distinct(), targets, "source", "left_anti", null_safe=False)
    current = pairs.withColumn("dist", F.lit(1)).unionByName(
        starts.select(F.lit(None).cast("string").alias("source"), F.col("source").alias("target"), F.lit(0).alias("dist"))
    )
    contracted = []
    while True:
        # the common start is a NULL source
        entered = current.groupBy(F.col("target").alias("name")).agg(
            F.count(F.lit(1)).alias("links"), F.max("source").alias("up"), F.max("dist").alias("dist")
        )
        single = staged(entered.where("links = 1").drop("links"), "flow-single")
        count = single.count()
        if not count:
            raise ValueError("the links form a cycle")
        single = _jumped(single, count)
        contracted.append(single)
        left = join_on(current, single.select(F.col("name").alias("target")), "target", "left_anti", null_safe=False)
        upward = single.select(F.col("name").alias("source"), "up", F.col("dist").alias("more"), F.lit(True).alias("known"))
        left = join_on(left, upward, "source", null_safe=False)
        source = F.when(F.col("known"), F.col("up")).otherwise(F.col("source"))
        left = left.select(source.alias("source"), "target", (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"))
        current = staged(left.groupBy("source", "target").agg(F.max("dist").alias("dist")), "flow-contracted")
        if current.isEmpty():
            break
    level = contracted.pop().select("name", F.col("dist").alias("level"))
    for single in reversed(contracted):
        above = join_on(single, level.select(F.col("name").alias("up"), "level"), "up", null_safe=False)
        here = above.select("name", (F.coalesce("level", F.lit(0)) + F.col("dist")).alias("level"))
        level = staged(level.unionByName(here), "flow-levels")
    depth = level.agg(F.max("level")).first()[0]
    sources = pairs.select(F.col("source").alias("name")).distinct().withColumn("leaves", F.lit(True))
    placed = join_on(level, sources, "name", null_safe=False)
    return placed.select("name", F.when(F.col("leaves").isNull(), F.lit(depth)).otherwise(F.col("level")).alias("level"))


def _without_overlap(state: DataFrame, height: float, padding: float) -> DataFrame:
    """Push nodes of a level apart, downward first, and back up from the bottom.

    In the order of (y, node), let d be the room that all nodes above take. Pushing down
    gives d + max(0, running maximum of y - d), and what stands out below is bounded by the
    place of the last node minus its own d. Both are prefix scans: rows are cut into chunks of
    (level, y), windows run inside a chunk, and one row per chunk carries the rest, so a
    level of any size is spread over tasks.
    """
    dealt = chunked(state.withColumn("room", (F.col("dy") + padding).cast(EXACT)), ["level", "y", "node"], "chunk")
    own = Window.partitionBy("level", "chunk").orderBy("y", "node")
    earlier, so_far = own.rowsBetween(Window.unboundedPreceding, -1), own.rowsBetween(Window.unboundedPreceding, 0)
    inside = dealt.withColumn("d", F.coalesce(F.sum("room").over(earlier), F.lit(0)).cast("double"))
    inside = inside.withColumn("m", F.max(F.col("y") - F.col("d")).over(so_far))
    order = F.struct("y", "node")
    ends = inside.groupBy("level", "chunk").agg(
        F.sum("room").alias("room"),
        F.max("m").alias("high"),
        F.max_by(F.col("dy") + F.col("d"), order).alias("foot"),
    )
    above = Window.partitionBy("level").orderBy("chunk")
    ends = ends.withColumn("d0", F.coalesce(F.sum("room").over(above.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double"))
    carried = F.max(F.col("high") - F.col("d0")).over(above.rowsBetween(Window.unboundedPreceding, -1))
    last = F.last(F.col("foot") + F.col("d0")).over(above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("level", "chunk", "d0", carried.alias("m0"), (F.lit(float(height)) - last).alias("bottom"))
    joined = join_on(inside, ends, ["level", "chunk"], null_safe=False)
    pushed = F.greatest(F.lit(0.0), F.col("m0"), F.col("m") - F.col("d0"))
    return joined.select("node", "level", "dy", (F.col("d0") + F.col("d") + F.least(pushed, "bottom")).alias("y"))


def _pulled(state: DataFrame, links: DataFrame, near: str, far: str, level: int, alpha: float) -> DataFrame:
    """Move a level's nodes towards the weighted mean of the centres at the far ends of their links."""
    centre: Column = F.col("y") + F.col("dy") / 2
    centres = state.select(F.col("node").alias(far), centre.alias("centre"))
    ends = join_on(links.where(F.col(f"{near}_level") == level), centres, far, null_safe=False)
    weighted = F.sum((F.col("centre") * F.col("value")).cast(EXACT)).cast("double")
    pull = F.try_divide(weighted, F.sum(F.col("value").cast(EXACT)).cast("double"))
    pulls = ends.groupBy(F.col(near).alias("node")).agg(pull.alias("pull"))
    moved = join_on(state, pulls, "node", null_safe=False)
    y = F.when(F.col("pull").isNotNull(), F.col("y") + (F.col("pull") - centre) * alpha).otherwise(F.col("y"))
    return moved.select("node", "level", "dy", y.alias("y"))


def node_positions(
    described: DataFrame, indexed: DataFrame, height: float, padding: float = 10.0, sweeps: int = SWEEPS
) -> DataFrame:
    """node, level, y, dy: place and height of every node on its level.

    described: (node, level, value); indexed: links of node numbers. The fullest level sets
    the scale. Each sweep pulls the levels, last to first, towards what they flow into, and
    then, first to last, towards what flows into them, a little less each time; nodes are
    pushed apart after either. State is written after each level, so plans stay short.
    """
    nodes_ = staged(described.select("node", "level", F.col("value").cast("double").alias("value")), "flow-described")
    by_level = nodes_.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast(EXACT)).cast("double").alias("value"))
    room = F.lit(float(height)) - (F.col("n") - 1) * float(padding)
    scale = by_level.agg(F.min(F.try_divide(room, F.col("value")))).first()[0] or 0.0
    first = number_rows(nodes_, "at", ["node"], ["level"])
    state = first.select("node", "level", (F.col("value") * scale).alias("dy"), (F.col("at") - 1).cast("double").alias("y"))
    places = nodes_.select("node", "level")
    ends = join_on(indexed, places.withColumnsRenamed({"node": "source_node", "level": "source_node_level"}), "source_node", null_safe=False)
    ends = join_on(ends, places.withColumnsRenamed({"node": "target_node", "level": "target_node_level"}), "target_node", null_safe=False)
    links = staged(ends.select("source_node", "target_node", "value", "source_node_level", "target_node_level"), "flow-ends")
    used = {side: sorted(r[0] for r in links.select(f"{side}_level").distinct().collect()) for side in ("source_node", "target_node")}
    state, alpha = staged(_without_overlap(state, height, padding), "flow-state"), 1.0
    for _ in range(sweeps):
        alpha *= COOLING
        for near, far, levels in (("source_node", "target_node", used["source_node"][::-1]), ("target_node", "source_node", used["target_node"])):
            for level in levels:
                state = staged(_pulled(state, links, near, far, level, alpha), "flow-state")
            state = staged(_without_overlap(state, height, padding), "flow-state")
    return state


def link_offsets(indexed: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Start of each link on both its nodes: the value of the links drawn before it.

    On the source side links lie in the order of their targets, and the other way round:
    by their place (`places`: node, y), to six digits, where that is known, and by number.
    Running totals read their input more than once, so it is written first.
    """
    links, orders = indexed, {"source": ["target_node"], "target": ["source_node"]}
    if places is not None:
        at = places.select("node", F.round("y", 6).alias("y"))  # places on two levels may be equal but for rounding errors
        links = join_on(links, at.withColumnsRenamed({"node": "source_node", "y": "__source_y"}), "source_node", null_safe=False)
        links = join_on(links, at.withColumnsRenamed({"node": "target_node", "y": "__target_y"}), "target_node", null_safe=False)
        orders = {"source": ["__target_y", "target_node"], "target": ["__source_y", "source_node"]}
    links = staged(links, "flow-links")
    out = staged(running_total(links, {"source_offset": "value"}, orders["source"], ["source_node"], before=True), "flow-links")
    both = running_total(out, {"target_offset": "value"}, orders["target"], ["target_node"], before=True)
    return both.drop("__source_y", "__target_y")


def adjacency(indexed: DataFrame, per_row: int = 1000) -> DataFrame:
    """node, side, part, links: link lists of every node, in pieces of at most `per_row`.

    A hub with very many links becomes many rows instead of one unbounded list.
    """
    sides = F.array(
        F.struct(F.col("source_node").alias("node"), F.lit("out").alias("side"), F.col("target_node").alias("other")),
        F.struct(F.col("target_node").alias("node"), F.lit("in").alias("side"), F.col("source_node").alias("other")),
    )
    ends = staged(indexed.select("position", "value", F.inline(sides)), "flow-ends")
    numbered = number_rows(ends, "at", ["position"], ["node", "side"])
    pieces = numbered.groupBy("node", "side", F.expr(f"int((at - 1) div {per_row})").alias("part"))
    lists = pieces.agg(F.sort_array(F.collect_list(F.struct("position", "other", "value"))).alias("links"))
    return lists


def flow_graph(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes with number, value and level; links with numbers and offsets)."""
    links = staged(links, "links")
    numbered = staged(nodes(links), "flow-nodes")
    described = join_on(join_on(numbered, throughput(links), "name", null_safe=False), node_levels(links), "name", null_safe=False)
    return described, link_offsets(indexed_links(links, numbered))


def flow_layout(links: DataFrame, height: float, padding: float = 10.0, sweeps: int = SWEEPS) -> tuple[DataFrame, DataFrame]:
    """What a chart draws: nodes with level, place and height; links with thickness and both offsets, in the same unit."""
    links = staged(links, "links")
    numbered = staged(nodes(links), "flow-nodes")
    described = join_on(join_on(numbered, throughput(links), "name", null_safe=False), node_levels(links), "name", null_safe=False)
    described, indexed = staged(described, "flow-described"), staged(indexed_links(links, numbered), "flow-links")
    places = staged(node_positions(described, indexed, height, padding, sweeps), "flow-places")
    drawn = join_on(described, places.drop("level"), "node", null_safe=False)
    unit = places.join(described.where("value > 0").select("node", "value"), "node").agg(F.max(F.col("dy") / F.col("value"))).first()[0]
    scaled = indexed.withColumn("value", F.col("value") * F.lit(unit))
    offsets = link_offsets(scaled, places)
    return drawn, offsets.select(
        "position", "source_node", "target_node", F.col("value").alias("dy"), F.col("source_offset").alias("sy"), F.col("target_offset").alias("ty")
    )
