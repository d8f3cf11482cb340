"""Schema operators: short column names, projection of wanted attributes.

The rules apply to a DataFrame of names (one row per column) with window
functions; a single schema's column list uses the same rule directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LIMIT = 10  # longest column name a shapefile keeps


def short_names_number_all(cols: list[str], limit: int = LIMIT) -> list[str]:
    """The ``number_all`` rule of ``short_names_table`` for one schema's column list."""
    cut = [c[:limit] for c in cols]
    rank = [str(1 + cut[:i].count(c)) for i, c in enumerate(cut)]
    return [c if cut.count(c) == 1 else c[: limit - len(k)] + k for c, k in zip(cut, rank)]


def short_names_table(names: DataFrame, rule: str, limit: int = LIMIT) -> DataFrame:
    """Same rules over a names table (grp, pos, name) -> (grp, pos, name, short).

    ``grp`` separates independent schemas; ``pos`` is the column position.
    keep_first: a cut name that is free is kept, else the first free one of its
    shorter cut with 1, 2, 3, ..; number_all: every holder of a shared cut name gets
    its running number.
    """
    if rule == "keep_first":
        return _first_free(names, limit)
    cut = F.substring("name", 1, limit)
    w = Window.partitionBy("grp", "cut").orderBy("pos")
    wc = Window.partitionBy("grp", "cut")
    df = names.withColumn("cut", cut).withColumn("k", F.row_number().over(w)).withColumn("n", F.count("*").over(wc))
    s = F.col("k").cast("string")
    short = F.when(F.col("n") == 1, F.col("cut")).otherwise(F.concat(F.expr(f"substring(cut, 1, {limit} - length(cast(k as string)))"), s))
    return df.select("grp", "pos", "name", short.alias("short"))


def _first_free(names: DataFrame, limit: int) -> DataFrame:
    """A schema's names are one row and are folded in the order of their columns, since a
    generated name may take the place of a later column's own."""
    listed = names.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("cols"))

    def named(taken, col):
        own = F.substring(col["name"], 1, limit)
        numbered = F.transform(F.sequence(F.lit(1), F.size(taken) + 1), lambda k: F.concat(F.substring(col["name"], 1, limit - 1), k.cast("string")))
        # as many numbered names as there are taken ones, and one more: one of them is free
        return F.get(F.filter(F.concat(F.array(own), numbered), lambda n: ~F.array_contains(taken, n)), F.lit(0))

    shorts = F.aggregate("cols", F.array().cast("array<string>"), lambda taken, col: F.concat(taken, F.array(named(taken, col))))
    rows = listed.select("grp", F.inline(F.arrays_zip(F.col("cols").alias("col"), shorts.alias("short"))))
    return rows.select("grp", "col.pos", "col.name", "short")
