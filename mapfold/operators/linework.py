"""Ordered lines and rings from directed edges, by list ranking.

Every edge points to the edge that goes on from its end.  Pointers are doubled
(each round an edge points twice as far), so a line of n edges is ordered in
log2(n) joins on edge numbers, whatever its length, and no line is gathered in
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapfold.operators.store import stored

EDGE = ["x1", "y1", "x2", "y2"]


def following(numbered: DataFrame, keys: list[str]) -> DataFrame:
    """(no, nxt): each edge and the edge that goes on from its end, if there is one.

    Where several start there, the sharpest left turn is taken: with the region
    left of the edges, rings that touch in a vertex stay apart.
    """
    into = numbered.select(*keys, "no", F.col("x2").alias("x"), F.col("y2").alias("y"), (F.col("x1") - F.col("x2")).alias("rx"), (F.col("y1") - F.col("y2")).alias("ry"))
    out = numbered.select(*keys, F.col("no").alias("nxt"), F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("dx"), (F.col("y2") - F.col("y1")).alias("dy"))
    met = into.join(out, [*keys, "x", "y"])
    # angle from the way back, clockwise, to the way on; straight back counts as a full turn
    angle = F.pmod(F.atan2("ry", "rx") - F.atan2("dy", "dx"), F.lit(6.283185307179586))
    angle = F.when(angle < 1e-12, F.lit(6.283185307179586)).otherwise(angle)
    return met.groupBy("no").agg(F.min_by("nxt", F.struct(angle, "nxt")).alias("nxt"))


def ranked(links: DataFrame) -> DataFrame:
    """(no, first, seq, size, closed) of every ``no`` of (no, nxt) links.

    ``nxt`` is null where a line ends, and no two rows have the same.  Rings
    (``closed``) begin with their least number; ``size`` counts the line's members.
    """
    nxt = stored(links.select("no", "nxt"), "linework-next")
    # the least number of each ring: minimum over twice as many followers a round, until
    # nothing changes; pointers of open lines run out, those of rings never do
    state, left = nxt.select("no", F.col("nxt").alias("to"), F.col("no").alias("low")), -1
    while True:
        ahead = state.select(F.col("no").alias("to"), F.col("to").alias("further"), F.col("low").alias("low2"))
        moved = F.coalesce(F.col("low2") < F.col("low"), F.lit(False)).alias("moved")
        grown = stored(state.join(ahead, "to", "left").select("no", F.col("further").alias("to"), F.least("low", "low2").alias("low"), moved), "linework-low")
        state = grown.drop("moved")
        moves, going = grown.agg(F.count_if("moved"), F.count("to")).first()
        if going == 0 or (not moves and going == left):
            break
        left = going
    on_ring = state.select("no", F.col("to").isNotNull().alias("closed"), "low")

    # rings are cut before their least number; then: how many follow, and the last of them
    goes_on = F.when(~(F.col("closed") & (F.col("nxt") == F.col("low"))), F.col("nxt"))
    rank = nxt.join(on_ring, "no").select("no", goes_on.alias("to")).select("no", "to", F.col("to").isNotNull().cast("long").alias("after"), F.coalesce("to", "no").alias("last"))
    rank = stored(rank, "linework-rank")
    while rank.where(F.col("to").isNotNull()).limit(1).count():
        ahead = rank.select(F.col("no").alias("to"), F.col("to").alias("further"), F.col("after").alias("after2"), F.col("last").alias("last2"))
        step = rank.join(ahead, "to", "left")
        rank = step.select("no", F.col("further").alias("to"), (F.col("after") + F.coalesce("after2", F.lit(0))).alias("after"), F.coalesce("last2", "last").alias("last"))
        rank = stored(rank, "linework-rank")
    lines = rank.groupBy("last").agg(F.max("after").alias("size"), F.max_by("no", "after").alias("first"))
    placed = rank.join(lines, "last").select("no", "first", (F.col("size") - F.col("after")).cast("int").alias("seq"), (F.col("size") + 1).cast("int").alias("size"))
    return placed.join(on_ring.select("no", "closed"), "no")


def chains(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., line, seq, x1, y1, x2, y2, closed): the edges as ordered lines.

    A ring begins with its least edge (by x1, y1, x2, y2), an open line with its
    start; lines of a key are numbered from 0 by their first edge.  Every vertex
    needs as many edges in as out for the rings to close; where an edge has no
    successor an open line ends.
    """
    numbered = stored(edges.select(*keys, *EDGE).orderBy(*keys, *EDGE).withColumn("no", F.monotonically_increasing_id()), "linework-edges")
    placed = stored(ranked(numbered.select("no").join(following(numbered, keys), "no", "left")), "linework-lines")
    heads = numbered.join(placed.where("seq = 0").select("no"), "no")
    heads = heads.select(F.col("no").alias("first"), (F.row_number().over(Window.partitionBy(*keys).orderBy("no")) - 1).alias("line"))
    return numbered.join(placed, "no").join(heads, "first").select(*keys, "line", "seq", *EDGE, "closed")
