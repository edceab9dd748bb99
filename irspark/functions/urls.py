"""Url columns: normal form, host test, resolution against a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from irspark.functions.binding import let

# Protocols that resolve to a url; anything else is malformed.
PROTOCOLS = ["http", "https", "ftp", "file", "jar", "mailto", "jrt"]
# Characters removed by a trim: everything up to the blank.
CONTROL = "".join(chr(c) for c in range(1, 33))

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_AUTHORITY = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)"


def normalize_url(url: Column) -> Column:
    """https becomes http, trailing slashes and newlines go, the rest is trimmed."""
    plain = F.regexp_replace(url, "^https://", "http://")
    plain = F.regexp_replace(plain, "/+$", "")
    plain = F.regexp_replace(plain, "\n", "")
    return F.btrim(plain, F.lit(CONTROL))


def scheme(url: Column) -> Column:
    """Lower-case protocol, empty when there is none."""
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def host(url: Column) -> Column:
    """Host of an absolute url without user and port, null when malformed."""
    authority = F.regexp_replace(F.regexp_extract(url, _AUTHORITY, 1), "^[^@]*@", "")
    name = F.regexp_extract(authority, r"^(\[[^\]]*\]|[^:]*)", 1)
    return F.when(scheme(url).isin(PROTOCOLS), name)


def same_host(url: Column, wanted: Column | str) -> Column:
    """True when the url is well formed and its host equals `wanted` exactly."""
    wanted = F.lit(wanted) if isinstance(wanted, str) else wanted
    return F.coalesce(host(F.btrim(url, F.lit(CONTROL))) == wanted, F.lit(False))


def clean_path(path: Column) -> Column:
    """Fold `.` and `..` segments; a `..` with nothing left to remove is kept."""
    segments = F.split(path, "/")
    last = F.size(segments) - 1

    def step(acc, pair):
        seg, pos = pair["seg"], pair["pos"]
        top = F.element_at(acc, -1)
        can_pop = (F.size(acc) > 1) & (top != "..")
        popped = F.slice(acc, 1, F.size(acc) - 1)
        # A closing dot segment leaves the slash behind.
        closing = F.when(pos == last, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return (
            F.when(seg == ".", F.concat(acc, closing))
            .when((seg == "..") & can_pop, F.concat(popped, closing))
            .otherwise(F.concat(acc, F.array(seg)))
        )

    numbered = F.transform(segments, lambda s, i: F.struct(s.alias("seg"), i.alias("pos")))
    folded = F.aggregate(numbered, F.array().cast("array<string>"), step)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.array_join(folded, "/")).otherwise(path)


def _absolute(base: Column, spec: Column) -> Column:
    """Url of a link without protocol on page `base`."""
    base_scheme = scheme(base)
    root = F.concat(base_scheme, F.lit("://"), F.regexp_extract(base, _AUTHORITY, 1))
    page = F.regexp_replace(base, "(?s)#.*$", "")
    page_path = F.regexp_extract(page, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?]*)", 1)
    page_query = F.regexp_extract(page, r"(?s)^[^?]*(\?.*)$", 1)
    folder = F.regexp_extract(page_path, "^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)

    body = F.regexp_replace(spec, "(?s)#.*$", "")
    fragment = F.regexp_extract(spec, "(?s)(#.*)$", 1)
    path = F.regexp_extract(body, r"^([^?]*)", 1)
    query = F.regexp_extract(body, r"(?s)^[^?]*(\?.*)$", 1)
    return (
        F.when(spec.startswith("//"), F.concat(base_scheme, F.lit(":"), spec))
        .when(spec.startswith("/"), F.concat(root, let(path, clean_path), query, fragment))
        .when(body == "", F.concat(root, page_path, page_query, fragment))
        .when(spec.startswith("?"), F.concat(root, folder, query, fragment))
        .otherwise(F.concat(root, let(F.concat(folder, path), clean_path), query, fragment))
    )


def resolve_url(base: Column, link: Column) -> Column:
    """Absolute form of a link found on page `base`, null when the result is malformed.

    A link made of a query only replaces the last path segment, an empty link keeps the query of
    the page, a fragment-only link keeps path and query, and `http:page` on an http page is read
    as a relative link.
    """

    def resolve(rel: Column) -> Column:
        own = scheme(rel)
        inherits = (own == scheme(base)) & ~rel.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://")
        spec = F.when(inherits, F.regexp_replace(rel, _SCHEME, "")).otherwise(rel)
        relative = F.when(
            scheme(base).isin(PROTOCOLS), let(spec, lambda s: _absolute(base, s))
        )
        return F.when((own != "") & ~inherits, F.when(own.isin(PROTOCOLS), rel)).otherwise(relative)

    return let(F.btrim(link, F.lit(CONTROL)), resolve)
