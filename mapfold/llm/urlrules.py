"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a host and a path: it fits the host and all its subdomains when the
url's path starts with the rule's.  Each rule becomes a regular expression and
is filed under one of its literal tokens (a host label, or a path segment that
must occur whole), the one that occurs in the fewest urls of the table.  A url's
own tokens fetch the rules filed under them, and only those expressions run; the
longest rule that fits decides.

The index is the rules per token, made of the rules alone.  Up to ``MAX_INLINE``
rules it is a literal map in the plan; Spark looks such a map up entry by entry,
so more rules go to the tasks as a broadcast dictionary (they are given as a
Python tuple, which bounds it).  Either way the judgement is one scan without
shuffle.

Defined cases: a null url, or one without ``://``, has empty host and path and
gets the default verdict; ports and user names count as part of the host, and so
do line breaks; very long urls are judged whole; repeated page ids are judged row
by row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapfold.llm.common import ship, table

MAX_INLINE = 40


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def host_pattern(self) -> str:
        return rf"(?s)^(?:.*\.)?{_quoted(self.host)}\z"

    @property
    def path_pattern(self) -> str:
        return f"^{_quoted(self.path)}"

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that every fitting url has: host labels, whole path segments."""
        whole = self.path.split("/")[1:-1]  # what follows the last slash may go on in the url
        return [f"h:{x}" for x in self.host.split(".")] + [f"p:{x}" for x in whole if x]


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def url_tokens(host: Column, path: Column) -> Column:
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, parts))


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    return rows.withColumn("tokens", url_tokens(F.col("host"), F.col("path")))


def index(rows: DataFrame, rules: tuple[Rule, ...]) -> dict[str, list[Rule]]:
    """Rules by the token of theirs that the fewest urls have."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if len(wanted) <= 200:
        listed = rows.select(F.explode(F.filter("tokens", lambda x: x.isin(*wanted))).alias("t"))
    else:
        keep = rows.sparkSession.createDataFrame([(t,) for t in wanted], "t string")
        listed = rows.select(F.explode("tokens").alias("t")).join(keep, "t", "left_semi")
    counts = {r["t"]: r["n"] for r in listed.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per rule token
    out: dict[str, list[Rule]] = {}
    for r in rules:
        out.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(r)
    return out


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    rows = parsed(pages, id_col, url_col)
    if not rules:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    filed = index(rows, rules)
    if len(rules) <= MAX_INLINE:
        entry = lambda r: F.struct(F.lit(len(r.name)).alias("size"), F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"), F.lit(r.host_pattern).alias("on_host"), F.lit(r.path_pattern).alias("on_path"))
        fetch = F.create_map(*[x for t, rs in sorted(filed.items()) for x in (F.lit(t), F.array(*[entry(r) for r in rs]))])
        got = F.flatten(F.transform(F.filter("tokens", lambda t: F.map_contains_key(fetch, t)), lambda t: fetch[t]))
        fits = F.filter(got, lambda r: F.regexp_like(F.col("host"), r["on_host"]) & F.regexp_like(F.col("path"), r["on_path"]))
        best = rows.withColumn("best", F.array_max(fits))
        return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    return _judged_in_tasks(rows.select("page_id", "host", "path", "tokens"), filed, default)


def _judged_in_tasks(rows: DataFrame, filed: dict[str, list[Rule]], default: str) -> DataFrame:
    ship(rows.sparkSession)
    # rules in the order of decision: longest first, then as the map form breaks ties
    order = {t: sorted(((len(r.name), r.name, r.verdict, r.host, r.path) for r in rs), reverse=True) for t, rs in filed.items()}
    held = rows.sparkSession.sparkContext.broadcast(order)
    id_type = rows.schema["page_id"].dataType.simpleString()

    def run(batches):
        known, tests = held.value, {}

        def fits(host: str, path: str, rule: tuple) -> bool:
            if rule[3:] not in tests:
                tests[rule[3:]] = re.compile(rf"(?s)(?:.*\.)?{_quoted(rule[3])}\Z"), re.compile(_quoted(rule[4]))
            on_host, on_path = tests[rule[3:]]
            return on_host.match(host) is not None and on_path.match(path) is not None

        for b in batches:
            best = []
            for host, path, tokens in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                found = [next((r for r in known[t] if fits(host, path, r)), None) for t in tokens if t in known]
                best.append(max((r for r in found if r), default=None))
            rule = pa.array([r and r[1] for r in best], pa.string())
            verdict = pa.array([r[2] if r else default for r in best], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], rule, verdict], names=["page_id", "host", "path", "rule", "verdict"])

    return rows.mapInArrow(run, f"page_id {id_type}, host string, path string, rule string, verdict string")


def op10_url_filters(spark, sf_dir: str) -> DataFrame:
    """Verdict of every page's url under the standing rules."""
    return judge(table(spark, sf_dir, "pages"))


def _oracle() -> str:
    """The same judgement as plain prefix comparisons, every rule against every url."""
    tests = {r: f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')" for r in RULES}
    longest = sorted(RULES, key=lambda r: -len(r.name))
    rule = " ".join(f"when {tests[r]} then '{r.name}'" for r in longest)
    verdict = " ".join(f"when {tests[r]} then '{r.verdict}'" for r in longest)
    return f"""with cut as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), parts as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path from cut
)
select page_id, host, path, case {rule} end as rule, case {verdict} else 'allow' end as verdict from parts"""


ORACLE = {"op10_url_filters": _oracle()}
