"""Name, path, URL and date functions as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def capitalize(s) -> Column:
    """First character upper, the rest lower (differs from initcap on multi-word names)."""
    s = _c(s)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


def slug(s) -> Column:
    """Every non-alphanumeric character becomes '_'."""
    return F.regexp_replace(_c(s), "[^a-zA-Z0-9]", "_")


def dir_name(s) -> Column:
    """Blanks and hyphens become '_'."""
    return F.translate(_c(s), " -", "__")


def source_abbr(s) -> Column:
    """Initials of the words starting upper-case, lower-cased; none -> first word lower."""
    words = F.split(_c(s), " ")
    caps = F.filter(words, lambda w: w.rlike("^[A-Z]"))
    initials = F.array_join(F.transform(caps, lambda w: F.substring(w, 1, 1)), "")
    return F.when(F.size(caps) > 0, F.lower(initials)).otherwise(F.lower(F.element_at(words, 1)))


def end_year(s) -> Column:
    """After the last '-', the last all-digit word, else 'Not Found'."""
    tail = F.element_at(F.split(_c(s), "-"), -1)
    digits = F.filter(F.split(tail, " "), lambda w: w.rlike("^[0-9]+$"))
    return F.coalesce(F.try_element_at(digits, F.lit(-1)), F.lit("Not Found"))


def epoch_date(s) -> Column:
    """All-digit text is epoch seconds -> 'dd MMMM yyyy'; other text unchanged."""
    s = _c(s)
    return F.when(
        s.rlike("^[0-9]+$"), F.date_format(F.timestamp_seconds(s.cast("long")), "dd MMMM yyyy")
    ).otherwise(s)


def split_ext(s) -> tuple[Column, Column]:
    """(stem, extension with dot) of a file name."""
    s = _c(s)
    return F.regexp_extract(s, r"^(.*?)(\.[^./]*)?$", 1), F.regexp_extract(s, r"^(.*?)(\.[^./]*)?$", 2)


def add_suffix(s, suffix: str) -> Column:
    stem, ext = split_ext(s)
    return F.concat(stem, F.lit(suffix), ext)


def url_path(url) -> Column:
    return F.regexp_replace(_c(url), "[?#].*$", "")


def basename(url) -> Column:
    """Last part of a path or URL (query and fragment dropped)."""
    return F.regexp_extract(url_path(url), "([^/]*)$", 1)


def url_host(url) -> Column:
    return F.regexp_extract(_c(url), "^(https?://[^/]+)", 1)


def absolute_url(href, page_url) -> Column:
    h = _c(href)
    return F.when(h.startswith("http"), h).otherwise(F.concat(url_host(page_url), h))


def filename_year(name, update_text) -> Column:
    """'{stem before first dot}_{last word of update text}.{ext}'."""
    n = _c(name)
    return F.concat(
        F.substring_index(n, ".", 1), F.lit("_"), F.element_at(F.split(_c(update_text), " "), -1),
        F.lit("."), F.substring_index(n, ".", -1),
    )


def header_filename(content_disposition, url) -> Column:
    """File name from a Content-Disposition header, else the last URL part."""
    cd = F.regexp_extract(F.coalesce(_c(content_disposition), F.lit("")), 'filename="?([^";]+)"?', 1)
    return F.coalesce(F.nullif(cd, F.lit("")), basename(url))


def tile_key(lat, lon) -> Column:
    """'N'/'S' + 2-digit latitude, 'E'/'W' + 3-digit longitude."""
    lat, lon = _c(lat), _c(lon)
    return F.concat(
        F.when(lat >= 0, F.lit("N")).otherwise(F.lit("S")), F.lpad(F.abs(lat).cast("string"), 2, "0"),
        F.when(lon >= 0, F.lit("E")).otherwise(F.lit("W")), F.lpad(F.abs(lon).cast("string"), 3, "0"),
    )


def layer_name(iso, category, theme, geom, scale, source, permission, free) -> Column:
    """The 8-token layer name iso_category_theme_geom_scale_source_permission_free."""
    return F.concat_ws("_", *map(_c, (iso, category, theme, geom, scale, source, permission, free)))


def layer_tokens(path) -> Column:
    """Tokens of the file stem split on '_'."""
    stem, _ = split_ext(basename(path))
    return F.split(stem, "_")


def country_from_path(path, root: str) -> Column:
    """Folder name of the country: the file's own folder if that lies directly in the folder
    ``root``, else the one two levels above it."""
    parts = F.split(_c(path), "/")
    return F.when(F.try_element_at(parts, F.lit(-3)) == root, F.try_element_at(parts, F.lit(-2))).otherwise(F.try_element_at(parts, F.lit(-4)))


def time_text(t) -> Column:
    """A time as ledger text."""
    return F.date_format(_c(t), "yyyy-MM-dd HH:mm:ss")
