"""Document fingerprints by spot signatures, in DataFrame functions only.

An anchor is a common word: one of the ``per_lang`` words that occur in most
documents of a language.  Where the six words before a word hold no common
word (lists, tables, shouted lines), the word itself is an anchor, so no stretch
of a text is left out.  The spot signature of an anchor's occurrence is the
anchor with the chain of the first two content words (words that are not common)
among the six words after it; fewer words make a shorter chain.
A text of at most 16 words also has each of its words as a signature.
A text's set holds its signatures with their occurrence numbers (a multiset),
each as 48 bits of an MD5 in hexadecimal; the fingerprint is the sorted set
joined together.

Two sets compare by Jaccard similarity.  Sets are dealt into partitions by
length: partition p holds the sizes from r^p to r^(p+1) with r = 1 / threshold,
so a set's partners at the threshold lie in its own partition and the two beside
it (:func:`near_pairs`).  Within them a pair is left out as soon as the lengths,
then the places of the shared signature in both sorted sets, bound it below the
threshold.  :func:`likeness` is the same comparison without a threshold: only
the bound 0 (an empty set) prunes.

Defined cases: a null text is empty; a text without words has one signature, of
itself, the empty text none; two empty sets have the likeness 1, one empty set 0; a repeated doc_id
follows in the order of (hash of text, text); rows with a null doc_id come after
all others in that order; further columns are ignored; the next document of an
only document is itself; an empty table gives no rows.  A text is one row: its
words are held in one task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapfold.llm.common import stored, table

PER_LANG = 16
MAX_LANGS = 64  # anchors of the largest languages: PER_LANG * MAX_LANGS words at most
REACH = 6
CHAIN = 2
SHORT = 16  # texts of at most so many words also have each word as a signature
ID_BITS = 7  # a window group holds at most 2^ID_BITS different ids
STEP_BITS = 12
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # between words: all of ASCII but a-z and 0-9, after lower-casing A-Z
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), BREAK), "")


def anchors(docs: DataFrame, per_lang: int = PER_LANG, max_langs: int = MAX_LANGS) -> list[str]:
    """The words in most documents of each language, ties to the smaller word.

    ``max_langs`` languages with most documents count, so the list that goes to
    every task has a fixed bound.
    """
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    langs = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()]
    rows = rows.where(F.col("lang").isin(langs))
    df = rows.select("lang", F.explode(F.array_distinct(words(F.col("text")))).alias("word")).groupBy("lang", "word").count()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
    top = df.withColumn("rank", rank).where(F.col("rank") <= per_lang)
    return sorted({r["word"] for r in top.select("word").collect()})


def with_set(rows: DataFrame, common: list[str], text: str = "text", out: str = "spots") -> DataFrame:
    """``rows`` and the sorted set of spot signatures of ``text`` in ``out``."""
    rows = rows.withColumn("_words", words(F.col(text))).withColumn("_common", F.transform("_words", lambda x: x.isin(common) if common else F.lit(False)))
    rows = rows.withColumn("_content", F.transform("_words", lambda x, i: F.when(~F.get("_common", i), x)))

    def spot(word: Column, i: Column) -> Column:
        near = reduce(Column.__or__, [F.coalesce(F.get("_common", i - k), F.lit(False)) for k in range(1, REACH + 1)])
        after = F.array_compact(F.array(*[F.get("_content", i + k) for k in range(1, REACH + 1)]))
        return F.when(F.get("_common", i) | ~near, F.concat_ws(" ", word, F.slice(after, 1, CHAIN)))

    alone = F.when(F.size("_words") <= SHORT, F.col("_words")).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("_found", F.sort_array(F.concat(F.array_compact(F.transform("_words", spot)), alone)))
    rows = rows.withColumn("_found", F.when((F.size("_words") == 0) & (F.col(text) != ""), F.array(F.col(text))).otherwise(F.col("_found")))
    # where each run of equal signatures starts; occurrence j of a signature is an element of its own
    rows = rows.withColumn("_starts", F.filter(F.sequence(F.lit(0), F.size("_found")), lambda i: (i == 0) | (i == F.size("_found")) | (F.get("_found", i) != F.get("_found", i - 1))))
    runs = F.transform(
        F.slice("_starts", 1, F.greatest(F.size("_starts") - 1, F.lit(0))),
        lambda at, k: F.transform(
            F.sequence(F.lit(1), F.get("_starts", k + 1) - at),
            lambda j: F.substring(F.md5(F.when(j == 1, F.get("_found", at)).otherwise(F.concat_ws("#", F.get("_found", at), j.cast("string")))), 1, 12),
        ),
    )
    return rows.withColumn(out, F.sort_array(F.array_distinct(F.flatten(runs)))).drop("_words", "_common", "_content", "_found", "_starts")


def fingerprint(spots: Column) -> Column:
    return F.array_join(spots, "")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two set columns; the length bound 0 is not intersected."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return F.when(large == 0, F.lit(1.0)).when(small == 0, F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def near_pairs(queries: DataFrame, sets: DataFrame, threshold: float = 0.8, key: str = "doc_id", spots: str = "spots") -> DataFrame:
    """(query, doc, likeness) of a stated query set against all sets, at ``threshold`` or more.

    Both sides carry ``key`` and a sorted set.  A query goes to its own length
    partition and the one on either side.  There it meets, under each signature
    of its prefix (a set that misses all of the first n - ceil(t n) + 1 cannot
    reach t), the sets with that signature in theirs; a pair is compared where
    its first common prefix signature stands, once, unless lengths or places
    bound it below the threshold.  A pair with an empty set never reaches it.
    """
    r = 1 / threshold

    def dealt(df: DataFrame, side: str) -> DataFrame:
        n = F.size(spots)
        rows = df.select(F.col(key).alias(side), F.col(spots).alias(f"{side}_set"), n.alias(f"{side}_n")).where(n > 0)
        part = F.floor(F.log(F.col(f"{side}_n").cast("double")) / math.log(r)).cast("int")
        head = F.slice(f"{side}_set", F.lit(1), (F.col(f"{side}_n") - F.ceil(F.col(f"{side}_n") * threshold - 1e-9) + 1).cast("int"))
        return rows.withColumn("part", part).select("*", F.posexplode(head).alias(f"{side}_at", "spot"))

    left = dealt(queries, "query").withColumn("part", F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)))
    pairs = left.join(dealt(sets, "doc"), ["part", "spot"])
    q, d = F.col("query_n"), F.col("doc_n")
    rest = F.least(q - F.col("query_at"), d - F.col("doc_at"))
    pairs = pairs.where((F.least(q, d) >= threshold * F.greatest(q, d) - 1e-9) & (rest >= threshold * (q + d - rest) - 1e-9))
    # sets are sorted, so the first shared signature is the least common one
    first = F.get(F.array_intersect("query_set", "doc_set"), F.lit(0)) == F.col("spot")
    return pairs.where(first).select("query", "doc", likeness("query_set", "doc_set").alias("likeness")).where(F.col("likeness") >= threshold - 1e-12)


def successors(keys: DataFrame, level: int = 4) -> DataFrame:
    """(k, nxt): for each distinct long ``k`` the next larger one, the first after the last.

    Keys are grouped by their high bits, the groups' first keys by theirs, and so
    on, so no task sees more than 2^STEP_BITS keys of a level.
    """
    if level == 0:
        w = Window.orderBy("k")  # at most 2^(64 - 4 * STEP_BITS) keys are left here
        return keys.select("k", F.coalesce(F.lead("k").over(w), F.min("k").over(Window.partitionBy(F.lit(0)))).alias("nxt"))
    high = keys.select("k", F.shiftright("k", STEP_BITS).alias("g"))
    inner = high.select("k", "g", F.lead("k").over(Window.partitionBy("g").orderBy("k")).alias("nxt"))
    groups = high.groupBy("g").agg(F.min("k").alias("first"))
    above = successors(groups.select(F.col("g").alias("k")), level - 1).select(F.col("k").alias("g"), F.col("nxt").alias("ng"))
    entry = above.join(groups.select(F.col("g").alias("ng"), "first"), "ng").select("g", "first")
    last = inner.where(F.col("nxt").isNull()).drop("nxt").join(entry, "g").select("k", F.col("first").alias("nxt"))
    return inner.where(F.col("nxt").isNotNull()).select("k", "nxt").unionByName(last)


def with_next(docs: DataFrame, common: list[str]) -> DataFrame:
    """doc_id, text, spots, next_text and next_spots (of the next document).

    Documents are dealt into window groups of 2^ID_BITS neighbouring ids (null ids
    by the hash of the text), and the first document of a group is also sent to
    the group before it, so one shuffle of the texts finds every next document.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_hash", F.xxhash64("text"))
    beyond = F.lit(1 << 60) + F.shiftrightunsigned("_hash", 52)
    rows = rows.withColumn("_group", F.coalesce(F.shiftright("doc_id", ID_BITS), beyond))
    firsts = rows.groupBy("_group").agg(F.min("doc_id").alias("_first_id"), F.min(F.when(F.col("doc_id").isNull(), F.col("_hash"))).alias("_first_hash"))
    firsts = stored(firsts, "spotsigs-groups")
    order = successors(firsts.select(F.col("_group").alias("k"))).select(F.col("k").alias("_before"), F.col("nxt").alias("_group"))
    entry = stored(firsts.join(order, "_group"), "spotsigs-entries")
    is_first = (F.col("doc_id") == F.col("_first_id")) | (F.col("doc_id").isNull() & (F.col("_hash") == F.col("_first_hash")))
    sent = rows.join(entry, "_group").where(is_first).select("doc_id", "text", "_hash", F.col("_before").alias("_group"), F.lit(1).alias("_sent"))
    both = rows.withColumn("_sent", F.lit(0)).unionByName(sent)
    w = Window.partitionBy("_group").orderBy("_sent", "doc_id", "_hash", "text")
    both = with_set(both.withColumn("next_text", F.lead("text").over(w)), common)
    both = both.withColumn("next_spots", F.lead("spots").over(w))
    return both.where("_sent = 0").drop("_sent", "_group", "_hash")


def op11_spotsigs(spark, sf_dir: str) -> DataFrame:
    """Every document against its edited text and against the next document."""
    docs = table(spark, sf_dir, "documents")
    common = anchors(docs)
    rows = with_next(docs, common).withColumn("n_chars", F.length("text"))
    tail = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.select(
        "doc_id",
        "spots",
        F.col("n_chars").cast("long").alias("n_chars"),
        "next_spots",
        F.concat(F.substring("text", F.lit(1), F.col("n_chars") - tail), F.substring("next_text", F.lit(1), tail)).alias("edited"),
    )
    rows = with_set(rows, common, "edited", "edited_spots")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("spots")).alias("fingerprint"),
        fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness("spots", "edited_spots").alias("near_edited"),
        likeness("spots", "next_spots").alias("near_next"),
    )


def _flags_sql(words: str) -> str:
    return f"list_transform({words}, lambda x: list_contains(a.words, x))"


def _set_sql(words: str, flags: str, text: str) -> str:
    near = f"list_bool_or(list_slice({flags}, greatest(i - {REACH}, 1), i - 1))"
    after = f"list_filter(list_slice({words}, i + 1, i + {REACH}), lambda x, k: not {flags}[i + k])"
    spot = f"case when {flags}[i] or i = 1 or not coalesce({near}, false) then array_to_string([w] || {after}[1:{CHAIN}], ' ') end"
    found = f"list_filter(list_transform({words}, lambda w, i: {spot}), lambda s: s is not null) || case when len({words}) <= {SHORT} then {words} else []::varchar[] end"
    return f"case when len({words}) > 0 then {found} when {text} <> '' then [{text}] else []::varchar[] end"


def _bag_sql(src: str, out: str, keep: str) -> str:
    """CTE ``out``: the found signatures of ``src`` numbered by occurrence, as sorted sets."""
    return f"""{out}_u as (select doc_id, unnest(found) as spot from {src}
), {out}_n as (select doc_id, spot, row_number() over (partition by doc_id, spot) as j from {out}_u
), {out}_g as (select doc_id as id, list_sort(list(distinct md5(case when j = 1 then spot else spot || '#' || j end)[1:12])) as spots from {out}_n group by doc_id
), {out} as (select {keep}, coalesce(spots, []::varchar[]) as spots from {src} left join {out}_g on id = doc_id)"""


def _words_sql(text: str) -> str:
    return f"regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '[^{BREAK[1:-2]}]+')"


def _near_sql(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"case when len({a}) + len({b}) = 0 then 1.0::double when len({a}) = 0 or len({b}) = 0 then 0.0::double else {both}::double / (len({a}) + len({b}) - {both}) end"


ORACLE = {
    "op11_spotsigs": f"""with d as (
  select doc_id, coalesce(lang, '') as lang, coalesce(text, '') as text, {_words_sql("coalesce(text, '')")} as words from documents
), l as (
  select lang from d group by lang order by count(*) desc, lang limit {MAX_LANGS}
), u as (
  select lang, unnest(list_distinct(words)) as word from d where lang in (select lang from l)
), c as (
  select lang, word, row_number() over (partition by lang order by count(*) desc, word) as rank from u group by lang, word
), a as (
  select list(distinct word) as words from c where rank <= {PER_LANG}
), df as (
  select doc_id, text, d.words, {_flags_sql("d.words")} as flags from d, a
), f as (
  select doc_id, text, {_set_sql("words", "flags", "text")} as found from df
), {_bag_sql("f", "s", "doc_id, text")}, n as (
  select *, length(text) as n_chars, coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id)) as next_text,
    coalesce(lead(spots) over (order by doc_id), first_value(spots) over (order by doc_id)) as next_spots from s
), e as (
  select *, substring(text, 1, n_chars - n_chars // 4) || substring(next_text, 1, n_chars // 4) as edited from n
), ew as (
  select *, {_words_sql("edited")} as ewords from e
), ewf as (
  select ew.*, {_flags_sql("ew.ewords")} as flags from ew, a
), ef as (
  select doc_id, n_chars, edited, spots as own, next_spots, {_set_sql("ewords", "flags", "edited")} as found from ewf
), {_bag_sql("ef", "es", "doc_id, n_chars, edited, own, next_spots")}
select doc_id, cast(n_chars as bigint) as n_chars, sha256(edited) as edited_sha256, array_to_string(own, '') as fingerprint,
  array_to_string(spots, '') as edited_fingerprint, {_near_sql("own", "spots")} as near_edited, {_near_sql("own", "next_spots")} as near_next from es"""
}
