"""Resource lists and metadata tables from page HTML, with built-in regex functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapfold.functions.names import filename_year


def page_resources(pages: DataFrame, suffixes=(".zip", ".csv")) -> DataFrame:
    """(page_id, title, href, updated, file_name) per ``<li>`` resource item.

    The href must end with one of ``suffixes``; file name = stem + '_' + last
    word of the update text + extension.
    """
    items = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?s)<li[^>]*>(.*?)</li>"), 1)).alias("pos", "li"))
    href = F.regexp_extract("li", r'href="([^"]+)"', 1)
    title = F.trim(F.regexp_extract("li", r"(?s)<h3[^>]*>(.*?)</h3>", 1))
    upd = F.trim(F.regexp_extract("li", r"(?s)class=\"update-date\"[^>]*>(.*?)<", 1))
    ok = F.lit(False)
    for s in suffixes:
        ok = ok | href.endswith(s)
    base = F.regexp_extract(href, r"([^/]*)$", 1)
    return items.where(ok).select("page_id", "pos", title.alias("title"), href.alias("href"), upd.alias("updated"),
                                  filename_year(base, upd).alias("file_name"))


def page_metadata(pages: DataFrame) -> DataFrame:
    """(page_id, meta map) from two-column ``<tr><th>key</th><td>value</td></tr>`` tables."""
    keys = F.regexp_extract_all("html", F.lit(r"(?s)<tr>\s*<th[^>]*>(.*?)</th>\s*<td[^>]*>.*?</td>"), 1)
    vals = F.regexp_extract_all("html", F.lit(r"(?s)<tr>\s*<th[^>]*>.*?</th>\s*<td[^>]*>(.*?)</td>"), 1)
    t = pages.select("page_id", F.transform(keys, F.trim).alias("k"), F.transform(vals, F.trim).alias("v"))
    return t.where(F.size("k") > 0).select("page_id", F.map_from_arrays("k", "v").alias("meta"))
