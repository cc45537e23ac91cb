"""Landed list pages to discovered documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.pages import find_all, resolve_url
from decreta.functions.text import strip


def _context(html: Column, start: Column) -> Column:
    """Characters around a position, ``LINK_CONTEXT_CHARS`` to either side."""
    half = K.LINK_CONTEXT_CHARS
    left = F.greatest(start - half, F.lit(1))
    return F.substring(html, left, (start + half - left).cast("int"))


def link_metadata(df: DataFrame, context: str, number_regex: Column, date_regex: Column,
                  title_regex: Column) -> DataFrame:
    """Order number, date, title and type read from the text around a link."""
    c = F.col(context)
    lower = F.lower(c)

    def found(pattern: Column) -> Column:
        hit = F.get(F.regexp_extract_all(c, pattern, F.lit(1)), F.lit(0))
        return F.nullif(strip(hit), F.lit(""))

    return df.withColumns({
        "order_number": F.coalesce(found(number_regex), F.lit("")),
        "order_date": F.coalesce(
            F.replace(found(date_regex), F.lit(" "), F.lit(".")), F.lit("")
        ),
        "title": F.when(title_regex != "", found(F.nullif(title_regex, F.lit("")))),
        "order_type": F.when(lower.contains("распоряжение"), "распоряжение").otherwise("приказ"),
    })


def _pattern(p: str | Column, default: str) -> Column:
    """A pattern given as text or, per source, as a column with a fallback."""
    if isinstance(p, Column):
        return F.coalesce(F.nullif(p, F.lit("")), F.lit(default))
    return F.lit(p or default)


def extract_links(pages: DataFrame, link_regex: str | Column = K.HREF_PDF,
                  keep: tuple[str, ...] = (), number_regex: str | Column = "",
                  date_regex: str | Column = "", title_regex: str | Column = "",
                  context: bool = True) -> DataFrame:
    """Links of every page, absolute, distinct per page in order of appearance.

    Reads ``url, html``. A page's links come out of one cell and are made distinct
    inside it, so the whole operator is map-side. The context of a link starts at the
    place its href stands in the page. Patterns may be columns: each source brings
    its own.
    """
    link = F.concat(F.lit("(?iu)"), _pattern(link_regex, K.HREF_PDF))
    group = F.when(link.rlike(r"(?<!\\)\((?!\?)"), 1).otherwise(0)
    hrefs = F.array_distinct(F.regexp_extract_all(F.col("html"), link, group))
    rules = {
        "_number": _pattern(number_regex, K.ORDER_NUMBER_IN_PAGE),
        "_date": _pattern(date_regex, K.ORDER_DATE_IN_PAGE),
        "_title": _pattern(title_regex, ""),
    } if context else {}
    base = pages.select(
        *keep, F.col("url").alias("page_url"), *(["html"] if context else []),
        *[c.alias(n) for n, c in rules.items()],
        F.posexplode(hrefs).alias("pos", "href"),
    )
    links = base.withColumn("url", resolve_url(F.col("page_url"), F.col("href")))
    links = links.withColumn(
        "file_url", F.when(F.lower("url").endswith(".pdf"), F.col("url"))
    )
    if not context:
        return links
    quoted = _quoted_position(F.col("html"), F.col("href"))
    links = links.withColumn("context", _context(F.col("html"), quoted)).drop("html")
    return link_metadata(
        links, "context", F.col("_number"), F.col("_date"), F.col("_title")
    ).drop(*rules)


def _quoted_position(html: Column, href: Column) -> Column:
    """Position of the href inside its quotes, else its first occurrence."""
    spots = [F.nullif(F.position(F.concat(F.lit(q), href, F.lit(q)), html), F.lit(0)) + 1
             for q in ('"', "'")]
    return F.coalesce(*spots, F.greatest(F.position(href, html), F.lit(1)))


def group_attachments(links: DataFrame, *tie: Column) -> DataFrame:
    """First link of a page is the main document, the others its numbered attachments.

    Reads ``page_url, pos, url`` as made by :func:`extract_links`, where positions are
    already dense per page. A window holds no more than the links of one page. Pages that
    share a URL are one group, whose main document is the first link of the page that
    comes first in ``tie``.
    """
    of_page = Window.partitionBy("page_url").orderBy("pos", *tie)
    further = F.col("pos") > 0
    return links.withColumn("_main", F.first("url").over(of_page)).select(
        "page_url", "url", F.when(further, F.col("_main")).alias("parent_url"),
        F.when(further, F.col("pos")).cast("int").alias("attachment_num"),
    )


def extract_embedded_json(pages: DataFrame, js_var: str | Column = "$obj",
                          keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents listed in a JSON value assigned to a script variable of the page.

    Accepts an array, an object that holds the list under ``data`` or ``items``, and a
    list given as an object of objects; keys have several accepted spellings. The
    variable may be a column: each source names its own.
    """
    var = F.concat(F.lit(r"(?s)\Q"), js_var if isinstance(js_var, Column) else F.lit(js_var), F.lit(r"\E\s*=\s*"))

    def assigned(value: str) -> Column:
        pattern = F.concat(var, F.lit(value))
        return F.nullif(F.call_function("regexp_extract", F.col("html"), pattern, F.lit(1)), F.lit(""))

    as_object, as_array = assigned(r"(\{.*?\});"), assigned(r"(\[.*?\]);")
    fields = F.from_json(as_object, "map<string,string>")
    listed = F.when(
        F.map_contains_key(fields, "data"), F.try_element_at(fields, F.lit("data"))
    ).otherwise(F.try_element_at(fields, F.lit("items")))
    text = F.when(as_object.isNotNull(), listed).otherwise(as_array)
    by_key = F.from_json(text, "map<string,string>")
    all_objects = F.forall(F.map_values(by_key), lambda v: v.startswith("{"))
    from_map = F.when(all_objects, F.map_values(by_key)).otherwise(F.array(text))
    items = F.when(text.startswith("["), F.from_json(text, "array<string>")).when(
        text.startswith("{"), from_map
    )
    rows = pages.select(*keep, F.col("url").alias("page_url"), F.posexplode(items).alias("pos", "_item"))
    rows = rows.filter(F.col("_item").startswith("{")).withColumn(
        "_m", F.from_json("_item", "map<string,string>")
    )

    def first_of(*names: str) -> Column:
        pick = F.lit("")
        for name in reversed(names):
            pick = F.when(F.map_contains_key("_m", name), F.coalesce(
                F.try_element_at("_m", F.lit(name)), F.lit("None" if name != "title" else ""))).otherwise(pick)
        return pick

    return rows.select(
        *keep, "page_url", "pos",
        resolve_url(F.col("page_url"), first_of("url", "link")).alias("url"),
        F.lit(None).cast("string").alias("file_url"),
        first_of("title", "name").alias("title"),
        first_of("number", "order_number").alias("order_number"),
        first_of("date", "order_date").alias("order_date"),
        F.lit("приказ").alias("order_type"),
    ).filter((F.col("url") != "") & (F.col("url") != F.col("page_url")))


def preview_regex(pages: DataFrame, pattern: str, html: str = "html", base: str = "url",
                  shown: int = 50, key: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """What a link pattern finds on each page: total, and the first matches resolved.

    ``shown`` bounds the preview only; ``total`` counts every match. A pattern that does
    not compile yields one row per page that carries the error.
    """
    import re

    try:
        hits = find_all(F.col(html), "(?iu)" + pattern)
    except re.error as err:
        return pages.select(
            *key, F.lit(False).alias("ok"), F.lit(f"Invalid regex: {err}").alias("error"),
            F.lit(0).alias("total"), F.lit(0).alias("shown"),
            F.array().cast("array<struct<raw:string,resolved:string>>").alias("matches"),
        )
    page = pages.select(*key, F.col(base).alias("_base"), hits.alias("_hits"))
    first = F.slice("_hits", 1, shown)
    return page.select(
        *key, F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"),
        F.size("_hits").alias("total"), F.size(first).alias("shown"),
        F.transform(first, lambda m: F.struct(
            m.alias("raw"), resolve_url(F.col("_base"), m).alias("resolved")
        )).alias("matches"),
    )
