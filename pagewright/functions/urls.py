"""URL functions over columns; none of them raises on a bad URL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def host(url: Column) -> Column:
    """Lower-cased host without `www.`, null for a URL that cannot be parsed."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"\Awww\.", "")


def normalize_post_url(href: Column, base: Column, site_host: str, pattern: str = r"^/archives/(\d+)/*$", form: str = "/archives/") -> Column:
    """The canonical address of a post on the site, null for any other link.

    Relative links are resolved against base for the forms that listings use: absolute URLs,
    //host/path, /path and paths beside the page. Scheme and host stay as written; query, fragment
    and trailing slash go.
    """
    h = F.trim(href)
    scheme = F.try_parse_url(base, F.lit("PROTOCOL"))
    authority = F.try_parse_url(base, F.lit("AUTHORITY"))
    folder = F.regexp_extract(F.coalesce(F.try_parse_url(base, F.lit("PATH")), F.lit("/")), r"^(.*/)", 1)
    absolute = (
        F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(scheme, F.lit("://"), authority, h))
        .otherwise(F.concat(scheme, F.lit("://"), authority, F.when(folder == "", "/").otherwise(folder), h))
    )
    to = F.try_parse_url(absolute, F.lit("AUTHORITY"))
    number = F.regexp_extract(F.coalesce(F.try_parse_url(absolute, F.lit("PATH")), F.lit("")), pattern, 1)
    ok = (F.replace(to, F.lit("www."), F.lit("")) == site_host) & (number != "")
    return F.when(ok, F.concat(F.try_parse_url(absolute, F.lit("PROTOCOL")), F.lit("://"), to, F.lit(form), number))


def document_id(value: Column) -> Column:
    """The 32 hexadecimal digits of an id or of the last part of a URL as 8-4-4-4-12, lower-cased; fails without them."""
    v = F.trim(value)
    last = F.when(v.contains("://"), F.regexp_extract(F.regexp_replace(F.coalesce(F.try_parse_url(v, F.lit("PATH")), F.lit("")), r"/+$", ""), r"([^/]*)$", 1)).otherwise(v)
    plain = F.replace(last, F.lit("-"), F.lit(""))
    at_end = F.regexp_extract(plain, r"([0-9a-fA-F]{32})$", 1)
    every = F.regexp_extract_all(plain, F.lit(r"([0-9a-fA-F]{32})"), F.lit(1))
    raw = F.lower(F.when(at_end != "", at_end).otherwise(F.try_element_at(every, F.lit(-1))))
    parts = F.concat_ws("-", *[F.substring(raw, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.when(raw.isNull(), F.raise_error(F.lit("no document id"))).otherwise(parts)
