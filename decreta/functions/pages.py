"""Landed web pages: fingerprints, flags, URLs, patterns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.text import collapse, strip


def page_fingerprint(html: Column) -> Column:
    """SHA-256 of what a reader sees: no scripts, styles, comments or volatile attributes."""
    c = F.regexp_replace(html, r"(?isu)<script[^>]*>.*?</script>", "")
    c = F.regexp_replace(c, r"(?isu)<style[^>]*>.*?</style>", "")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    c = strip(collapse(c))
    c = F.regexp_replace(
        c, r"""(?iu)(csrf|nonce|token|session|timestamp)=["'][^"']*["']""", ""
    )
    return F.sha2(c, 256)


def is_challenge_page(html: Column) -> Column:
    """Whether the page is a bot challenge instead of content."""
    lower = F.lower(html)
    return reduce(lambda a, b: a | b, [lower.contains(m) for m in K.CHALLENGE_MARKERS])


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def url_authority(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def url_host(url: Column) -> Column:
    """Lower-case host without user info, port or outer dots."""
    host = F.regexp_extract(url_authority(url), r"^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)", 1)
    return F.lower(F.btrim(host, F.lit(".")))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(path, "/")
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(
        F.array().cast("array<string>")
    )

    def step(acc: Column, seg: Column) -> Column:
        shorter = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        return (
            F.when(seg == "..", shorter)
            .when(seg == ".", acc)
            .otherwise(F.concat(acc, F.array(seg)))
        )

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    joined = F.array_join(F.concat(kept, tail), "/")
    rooted = F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))
    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), rooted).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """``href`` as found on the page at ``base``, made absolute.

    Links with another scheme stay as they are; everything is built from column
    expressions, so link resolution runs inside the scan stage.
    """
    scheme, authority = url_scheme(base), url_authority(base)
    root = F.concat(scheme, F.lit("://"), authority)
    bare_base = F.regexp_extract(base, r"^([^#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    base_path = url_path(base)
    folder = F.regexp_extract(base_path, r"^(.*/)[^/]*$", 1)
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    suffix = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    own_scheme = href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:")
    relative = F.regexp_replace(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path), "(?<!^)/{2,}", "/"
    )
    return (
        F.when(href == "", base)
        .when(own_scheme, href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("#"), F.concat(bare_base, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .when(href.startswith("/"), F.concat(root, _without_dots(
            F.regexp_replace(path, "(?<=.)/{2,}", "/")), suffix))
        .otherwise(F.concat(root, _without_dots(relative), suffix))
    )


def pattern_groups(pattern: str) -> int:
    """Number of capturing groups; raises ``re.error`` on a bad pattern."""
    return re.compile(pattern).groups


def find_all(c: Column, pattern: str) -> Column:
    """All matches: the first group when the pattern has one, else the whole match."""
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(1 if pattern_groups(pattern) else 0))

