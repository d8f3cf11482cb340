"""Road network edges from ways: cut at junctions, contracted between them.

A way is a list of nodes; every step of it is a segment, in both directions
unless the way is one-way.  A node lies inside an edge if it only passes traffic
on: two neighbours, and one (one-way) or two (two-way) segments on each side.
All other nodes are junctions or ends.  Chains of segments between them, across
way borders, become one edge whose attributes are the sorted distinct values of
its segments.

Steps that go on along their own way are put together in one pass over the way;
only what is left, the stretches of ways between junctions and way ends, is linked
across ways, and only stretches that have a link are ordered by pointer doubling
(:func:`mapfold.operators.linework.ranked`).  Whether a node is a junction is an
aggregate of fixed width, so a node on very many ways is combined before it is
shuffled and never joined with itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapfold.operators.linework import ranked
from mapfold.operators.store import stored


def stops(steps: DataFrame, keys: list[str]) -> DataFrame:
    """The way nodes (keys.., way_id, seq, node_id, oneway, ..) that a step of their way begins or ends at.

    Adds ``_at``, the place along the way, ``_prev`` and ``_next``, the nodes a step away (null: no
    step), and ``_prev_oneway``.  Missing nodes break a way.
    """
    along = Window.partitionBy(*keys, "way_id").orderBy("seq")
    near = {"_at": F.row_number().over(along), "_prev_oneway": F.lag("oneway").over(along)}
    for name, step in (("_prev", F.lag), ("_next", F.lead)):
        near |= {f"{name}_seq": step("seq").over(along), name: step("node_id").over(along)}
    rows = steps.withColumns(near)
    for name, gap in (("_prev", -1), ("_next", 1)):
        rows = rows.withColumn(name, F.when((F.col(f"{name}_seq") == F.col("seq") + gap) & (F.col(name) != F.col("node_id")), F.col(name)))
    return rows.drop("_prev_seq", "_next_seq").where(F.col("_prev").isNotNull() | F.col("_next").isNotNull())


def through_nodes(at: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., node_id) of the nodes of ``stops`` that lie inside an edge."""
    into = ["_prev", F.when(~F.col("oneway"), F.col("_next"))]
    out = ["_next", F.when(~F.col("_prev_oneway"), F.col("_prev"))]
    aggs = []
    for name, (a, b) in (("into", into), ("out", out)):
        aggs += [F.sum(sum((F.when(c.isNotNull(), 1).otherwise(0) for c in (F.col(a), b)), F.lit(0))).alias(name), F.min(F.least(a, b)).alias(f"{name}_low"), F.max(F.greatest(a, b)).alias(f"{name}_high")]
    node = at.groupBy(*keys, "node_id").agg(*aggs)
    # two neighbours, one segment each way at most, as many in as out: one in from one neighbour
    # and one out to another, or both to and from the same two
    one_way = (F.col("into") == 1) & (F.col("out") == 1) & (F.col("into_low") != F.col("out_low"))
    two_way = (F.col("into") == 2) & (F.col("out") == 2) & (F.col("into_low") < F.col("into_high")) & (F.col("into_low") == F.col("out_low")) & (F.col("into_high") == F.col("out_high"))
    return node.where(one_way | two_way).select(*keys, "node_id")


def stretches(steps: DataFrame, keys: list[str], attributes: list[str], node_columns: Sequence[str] = ()) -> DataFrame:
    """(no, keys.., way_id, nodes, seq, begins, ends, two_way, attributes..): the parts of each way whose
    steps go on into each other.

    ``nodes`` are structs of the node and its columns, ``seq`` is the first one's; ``begins`` and
    ``ends`` say whether the outer nodes lie inside an edge; attributes are arrays of the distinct values.
    """
    at = stored(stops(steps, keys), "road-stops")
    through = through_nodes(at, keys).withColumn("_through", F.lit(True))
    at = at.join(through, [*keys, "node_id"], "left").withColumn("_through", F.coalesce("_through", F.lit(False)))
    along = Window.partitionBy(*keys, "way_id").orderBy("_at")
    goes_on = F.col("_through") & (F.col("_prev") != F.col("_next")) & F.col("_prev_oneway").eqNullSafe(F.col("oneway"))
    rows = at.withColumn("_node", F.struct("node_id", *node_columns)).withColumns({
        "_part": F.sum(F.when(goes_on, 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, 0)),
        "_to": F.lead("_node").over(along), "_to_through": F.lead("_through").over(along),
    }).where(F.col("_next").isNotNull())
    own = F.array_sort(F.collect_list(F.struct("_at", "seq", "_node", "_to", "_through", "_to_through", "oneway", *attributes)))
    parts = rows.groupBy(*keys, "way_id", "_part").agg(own.alias("_s"))
    head, tail = F.get("_s", F.lit(0)), F.element_at("_s", -1)
    parts = parts.select(
        *keys, "way_id", F.concat(F.array(head["_node"]), F.col("_s._to")).alias("nodes"), head["seq"].alias("seq"), head["_through"].alias("begins"), tail["_to_through"].alias("ends"),
        F.coalesce(~head["oneway"], F.lit(False)).alias("two_way"), *[F.array_distinct(F.array_compact(F.col("_s")[a])).alias(a) for a in attributes],
    )
    return stored(parts.withColumn("no", F.monotonically_increasing_id()), "road-stretches")


def _both_ways(parts: DataFrame) -> DataFrame:
    """Every stretch and, if it is two-way, its way back: numbered 2 no and 2 no + 1."""
    ways = parts.withColumn("back", F.explode(F.when(F.col("two_way"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    turned = lambda a, b: F.when(F.col("back"), F.col(b)).otherwise(F.col(a))
    return ways.withColumns({
        "no": F.col("no") * 2 + F.col("back").cast("long"), "nodes": F.when(F.col("back"), F.reverse("nodes")).otherwise(F.col("nodes")),
        "begins": turned("begins", "ends"), "ends": turned("ends", "begins"),
        "seq": F.when(F.col("back"), F.col("seq") + F.size("nodes") - 2).otherwise(F.col("seq")),
    })


def _ring_start(parts: Column) -> Column:
    """The place, from 1, of a ring's least segment by (u, v, way_id, seq) in its stretches."""

    def segments(p: Column) -> Column:
        def segment(n: Column, i: Column) -> Column:
            return F.struct(n["node_id"].alias("u"), F.get(p["nodes"], i + 1)["node_id"].alias("v"), p["way_id"].alias("way_id"), (p["seq"] + F.when(p["back"], -i).otherwise(i)).alias("seq"))

        return F.transform(F.slice(p["nodes"], F.lit(1), F.size(p["nodes"]) - 1), segment)

    all_ = F.flatten(F.transform(parts, segments))
    return F.array_position(all_, F.array_min(all_)).cast("int")


def road_edges(steps: DataFrame, keys: list[str], attributes: list[str], node_columns: Sequence[str] = ()) -> DataFrame:
    """(keys.., u, v, n_segments, way_ids, attributes.., nodes, node_columns..): one row per edge and direction.

    ``steps`` are way nodes (keys.., way_id, seq, node_id, oneway, attributes.., node_columns..).
    ``way_ids`` and the attributes are sorted arrays of the distinct values;
    ``nodes`` lists the nodes in order, which is the edge's geometry, and each of
    ``node_columns`` their values.  A closed chain without any junction is one edge
    from its first segment's node to itself.
    """
    ways = _both_ways(stretches(steps, keys, attributes, node_columns))
    ends = ways.select(
        *keys, "no", "begins", "ends", F.get("nodes", F.lit(0))["node_id"].alias("u"), F.get("nodes", F.lit(1))["node_id"].alias("second"),
        F.element_at("nodes", -2)["node_id"].alias("before"), F.element_at("nodes", -1)["node_id"].alias("v"),
    )
    into = ends.where("ends").select(*keys, F.col("v").alias("mid"), "before", "no")
    out = ends.where("begins").select(*keys, F.col("u").alias("mid"), "second", F.col("no").alias("nxt"))
    # a node inside an edge has one way on that is not the way back
    links = into.join(out, [*keys, "mid"]).where(F.col("before") != F.col("second")).select("no", "nxt")
    line = ranked(ends.where("begins or ends").select("no").join(links, "no", "left"))

    alone = ways.where("not begins and not ends").select(*keys, F.array("way_id").alias("way_ids"), *attributes, "nodes")
    # an edge is one row of the result: its own stretches, however many, are gathered
    parts = ways.join(line.withColumnRenamed("seq", "place"), "no").groupBy(*keys, "first").agg(
        F.array_sort(F.collect_list(F.struct("place", "way_id", "seq", "back", "nodes", *attributes))).alias("s"), F.max("closed").alias("closed")
    )
    joined = F.concat(F.array(F.get(F.get("s", F.lit(0))["nodes"], F.lit(0))), F.flatten(F.transform("s", lambda p: F.slice(p["nodes"], F.lit(2), F.size(p["nodes"])))))
    parts = parts.withColumn("nodes", joined).withColumn("start", F.when(F.col("closed"), _ring_start(F.col("s"))).otherwise(1))
    turned = F.concat(F.slice("nodes", F.col("start"), F.size("nodes") - F.col("start") + 1), F.slice("nodes", F.lit(2), F.col("start") - 1))
    parts = parts.select(
        *keys, F.col("s.way_id").alias("way_ids"), *[F.flatten(F.col("s")[a]).alias(a) for a in attributes], F.when(F.col("start") > 1, turned).otherwise(F.col("nodes")).alias("nodes")
    )
    every = alone.unionByName(parts)
    distinct = [F.array_sort(F.array_distinct(F.array_compact(a))).alias(a) for a in ("way_ids", *attributes)]
    return every.select(
        *keys, F.get("nodes", F.lit(0))["node_id"].alias("u"), F.element_at("nodes", -1)["node_id"].alias("v"), (F.size("nodes") - 1).alias("n_segments"), *distinct,
        F.col("nodes.node_id").alias("nodes"), *[F.col("nodes")[c].alias(c) for c in node_columns],
    )
