"""Source divergence audit: how far the word use of the sources of a language
lies apart, by three-dimensional cube partitioning.

A group is a (lang, source).  Terms are counted per group; a language keeps the
terms of at least ``min_docs`` of its documents.  A group's smoothed share of a
kept term is p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and two groups diverge
by floor((p - q)^2 / (p + q)), summed over the kept terms.  All of it is integer
arithmetic.

The sum over all pairs of groups and all terms is a cube.  Groups are dealt into
blocks of about ``group_block`` and kept terms into blocks of about
``term_block`` by hash; a task owns one cell (group block, group block, term
block) of it.  A group's slice of a term block is sent to every cell of its row
and column, so a cell holds at most two group blocks of one term block and needs
nothing else; it gives one partial divergence per pair, and the partials are
added along the term axis.  Cells of (j, i) are those of (i, j), so only i <= j
are made.  Terms that neither block uses are not sent: they count once per pair
with the shares of the count 0.

Defined cases: null text, lang and source are ''; a group without terms has the
count 0 everywhere; a language without kept terms has the divergence 0 for every
pair and no term rows; rows that repeat a doc_id are documents of their own;
further columns are ignored; an empty table gives no rows.  Shares are exact
while N + 2 V is under 9 * 10^13.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapfold.llm.common import ship, stored, table

MIN_DOCS = 10
GROUP_BLOCK = 32
TERM_BLOCK = 4096
TOP = 10
SCALE = 1_000_000_000
FLUSH = 200_000  # entries a counting task holds before it passes them on
CHUNK = 1 << 20

#: A-Z to lower case, letters and bytes of non-ASCII characters kept, the rest blank
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about CHUNK bytes."""
    data = text.encode("utf-8", "replace").translate(_TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", min(at + CHUNK, len(data)))
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uses: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def passed_on() -> pa.RecordBatch:
        keys = [(lang, source, t.decode("utf-8", "replace"), n, docs[t]) for (lang, source), (all_, docs) in uses.items() for t, n in all_.items()]
        cols = list(zip(*keys)) if keys else [[]] * 5
        uses.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, [pa.string()] * 3 + [pa.int64()] * 2)], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i) for i in range(3))):
            all_, docs = uses.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            seen: set[bytes] = set()
            held -= len(all_)
            for listed in _terms(text.as_py()):
                all_.update(listed)
                seen.update(listed)
            docs.update(seen)
            held += len(all_)
            if held > FLUSH:
                yield passed_on()
                held = 0
    yield passed_on()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with the term)."""
    ship(docs.sparkSession)
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    part = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, v: Column) -> Column:
    """p as a column, exact: the product is a decimal."""
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(38,0)") * (count + 2).cast("decimal(20,0)"), (total + 2 * v).cast("decimal(20,0)"))


def shares(count: np.ndarray, total: np.ndarray, v: int) -> np.ndarray:
    """p of int64 counts, exact: 10^9 is multiplied in two steps of a long division."""
    d = total + 2 * v
    q, r = np.divmod(count + 2, d)
    for step in (100_000, 10_000):
        more, r = np.divmod(r * step, d)
        q = q * step + more
    return q + 1


def _cell(rows: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences of a cell: rows without a term name the groups, the others their counts."""
    head = rows[rows["term"].isna()].sort_values(["block", "source"])
    used = rows[rows["term"].notna()]
    names = head["source"].to_numpy()
    v, vt, lo, hi = (int(head[c].iloc[0]) for c in ("v", "vt", "lo", "hi"))
    at = pd.Series(np.arange(len(names)), index=names)
    codes, terms = pd.factorize(used["term"])
    counts = np.zeros((len(names), len(terms) + 1), np.int64)  # the last column stands for a term nobody here uses
    counts[at.loc[used["source"]].to_numpy(), codes] = used["n"].to_numpy(np.int64)
    p = shares(counts, head["total"].to_numpy(np.int64)[:, None], v) if v else np.zeros(counts.shape, np.int64)
    weight = np.ones(p.shape[1], np.int64)
    weight[-1] = vt - len(terms)
    left = np.flatnonzero(head["block"].to_numpy() == lo)
    right = np.flatnonzero(head["block"].to_numpy() == hi)
    a, b, values = [], [], []
    for i in left:
        others = right[right > i] if lo == hi else right
        d = p[others] - p[i]
        values += (((d * d) // np.maximum(p[others] + p[i], 1)) @ weight).tolist()
        a += [names[i]] * len(others)
        b += names[others].tolist()
    text = {"lang": [rows["lang"].iloc[0]] * len(a), "a": a, "b": b}
    return pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in text.items()} | {"value": pd.Series(values, dtype=np.int64)})


def cube(groups: DataFrame, used: DataFrame, langs: DataFrame, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """lang, a, b, value: the divergence of every unordered pair of groups of a language.

    ``groups``: lang, source, total (N); ``used``: lang, source, term, n of kept
    terms with a count; ``langs``: lang, v (kept terms), n_groups.
    """
    size = langs.select("lang", "v", F.ceil(F.col("n_groups") / group_block).cast("int").alias("nb"), F.greatest(F.ceil(F.col("v") / term_block), F.lit(1)).cast("int").alias("nt"))
    block = F.pmod(F.xxhash64("source"), F.col("nb")).cast("int").alias("block")
    term_slot = F.pmod(F.xxhash64("term"), F.col("nt")).cast("int").alias("t")
    blocks = F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other")
    per_slot = used.select("lang", "term").distinct().join(size, "lang").groupBy("lang", term_slot).agg(F.count("*").alias("vt"))
    heads = groups.join(size, "lang").select("lang", "source", "total", "v", "nb", block, F.explode(F.sequence(F.lit(0), F.col("nt") - 1)).alias("t"))
    heads = heads.join(per_slot, ["lang", "t"], "left").select("lang", "t", "block", blocks, "source", "total", "v", F.coalesce("vt", F.lit(0)).alias("vt"), F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("n"))
    zero = F.lit(0).cast("long")
    slices = used.join(size, "lang").select("lang", term_slot, block, blocks, "source", zero.alias("total"), "v", zero.alias("vt"), "term", "n")
    rows = heads.unionByName(slices).select("*", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")).drop("other")
    part = rows.groupBy("lang", "lo", "hi", "t").applyInPandas(_cell, "lang string, a string, b string, value long")
    return part.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language by
    divergence, and the ``top`` terms that a source uses most beyond its language."""
    counts = stored(term_counts(docs), "divergence-counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).where(F.col("docs") >= min_docs)
    terms = stored(terms.select("lang", "term", F.col("n").alias("lang_n")), "divergence-terms")
    used = stored(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "divergence-used")
    named = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = named.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0).cast("long")).alias("total"))
    groups = stored(groups, "divergence-groups")
    kept = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("n_groups")).join(kept, "lang", "left")
    langs = stored(langs.na.fill({"v": 0, "lang_total": 0}), "divergence-langs")

    one_way = cube(groups, used.drop("lang_n"), langs.drop("lang_total"), group_block, term_block)
    ends = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = one_way.select("lang", F.explode(ends).alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    p, q = F.col("p"), F.col("q")
    rows = used.join(groups, ["lang", "source"]).join(langs, "lang")
    rows = rows.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))
    rows = rows.where(p > q).select("lang", "source", F.lit("term").alias("part"), "item", F.call_function("div", (p - q) * (p - q), p + q).alias("value"))
    best = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(best)


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = {
    "op12_divergence": rf"""with d as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents
), u as (
  select row, lang, source, unnest(terms) as term from d
), k as (
  select lang, term, cast(count(*) as hugeint) as n from u group by lang, term having count(distinct row) >= {MIN_DOCS}
), l as (
  select lang, sum(n) as total, cast(count(*) as hugeint) as v from k group by lang
), g as (
  select distinct lang, source from d
), c as (
  select lang, source, term, count(*) as n from u group by lang, source, term
), dense as (
  select g.lang, g.source, k.term, cast(coalesce(c.n, 0) as hugeint) as n, k.n as lang_n from g join k on k.lang = g.lang
    left join c on c.lang = g.lang and c.source = g.source and c.term = k.term
), t as (
  select lang, source, sum(n) as total from dense group by lang, source
), p as (
  select dense.lang, dense.source, dense.term, dense.n, 1 + ({SCALE} * (dense.n + 2)) // (t.total + 2 * l.v) as p, 1 + ({SCALE} * (lang_n + 2)) // (l.total + 2 * l.v) as q
  from dense join t on t.lang = dense.lang and t.source = dense.source join l on l.lang = dense.lang
), pv as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(pv.value, 0) as bigint) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join pv on pv.lang = a.lang and pv.source = a.source and pv.item = b.source
), terms as (
  select lang, source, 'term' as part, term as item, cast((p - q) * (p - q) // (p + q) as bigint) as value from p where n > 0 and p > q
), r as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from (select * from pairs union all select * from terms)
)
select lang, source, part, item, value, rank from r where part = 'pair' or rank <= {TOP}"""
}
