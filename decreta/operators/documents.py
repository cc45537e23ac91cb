"""Document text: pages, lines, chunks, assembly, award lines, model responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.text import (
    bind, readable_chars, readable_ratio, render_template, strip, text_lines, text_pages,
)
from decreta.functions.records import coerce_assignment
from decreta.schemas import RESPONSE_ITEM


# --- rows out of one document ----------------------------------------------------
def split_pages(df: DataFrame, doc: str, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per non-blank page, numbered from 1; a map-side explode."""
    return df.select(
        doc, *keep, F.posexplode(text_pages(F.col(text))).alias("page_no", "page_text")
    ).withColumn("page_no", F.col("page_no") + 1)


def split_lines(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """One row per non-blank line with its position."""
    return df.select(
        *keys, F.posexplode(text_lines(F.col(text))).alias("line_no", "line")
    ).filter(F.col("line") != "")


def parse_awards(df: DataFrame, doc: str, text: str, pattern: str = K.AWARD_LINE) -> DataFrame:
    """Rows of "Name - award" lines, in text order."""
    hits = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    return df.select(doc, F.posexplode(hits).alias("pos", "_hit")).select(
        doc, "pos",
        F.regexp_extract("_hit", pattern, 1).alias("name"),
        strip(F.regexp_extract("_hit", pattern, 2)).alias("award"),
    )


# Where the piece that starts after {at} characters ends: after the last blank line that
# fits, else after the last line break, else at the full size.
_PIECE_END = """CASE WHEN length({t}) - {at} <= {n} THEN length({t})
  WHEN instr(reverse(substr({t}, {at} + 1, {n})), '\n\n') > 0 THEN {at} + {n} + 1 - instr(reverse(substr({t}, {at} + 1, {n})), '\n\n')
  WHEN instr(reverse(substr({t}, {at} + 1, {n})), '\n') > 0 THEN {at} + {n} + 1 - instr(reverse(substr({t}, {at} + 1, {n})), '\n')
  ELSE {at} + {n} END"""


def chunk_text(df: DataFrame, doc: str, text: str, size: int = K.CHUNK_CHARS) -> DataFrame:
    """Chunks of at most ``size`` characters that put together are the text.

    A fold over column expressions collects the ends: any three chunks in a row hold more
    than ``size`` characters, which bounds the number of steps. An empty text is one
    empty chunk, a null text none.
    """
    last = "element_at(ends, -1)"
    step = _PIECE_END.format(t=f"`{text}`", at=last, n=size)
    ends = F.expr(f"""aggregate(sequence(1, 3 * CAST(ceil(length(`{text}`) / {size}) AS INT) + 1), array(0),
      (ends, i) -> IF({last} >= length(`{text}`), ends, concat(ends, array({step}))))""")
    parts = F.expr(f"""IF(size(_ends) = 1, array(''), transform(slice(_ends, 2, size(_ends) - 1),
      (e, i) -> substr(`{text}`, _ends[i] + 1, e - _ends[i])))""")
    return df.filter(F.col(text).isNotNull()).withColumn("_ends", ends).select(doc, F.posexplode(parts).alias("chunk_no", "chunk"))


def render_prompt(df: DataFrame, template: str) -> DataFrame:
    """Prompt text of each chunk; blank order fields take their stand-in words."""
    fields = {n: F.col(n) for n in ("text", "issuing_body", "order_date", "order_number")}
    blanks = {"issuing_body": "не указан", "order_date": "не указана", "order_number": "не указан"}
    return df.withColumn("prompt", render_template(template, fields, blanks))


def answered_keys(df: DataFrame, key: Sequence[str], response: str) -> DataFrame:
    """Keys whose response is an array, also an empty one: the model has answered."""
    body = F.nullif(F.regexp_extract(response, r"(?s)\[.*\]", 0), F.lit(""))
    return df.filter(F.from_json(body, "array<string>").isNotNull()).select(*key).distinct()


def parse_json_response(df: DataFrame, key: Sequence[str], response: str) -> tuple[DataFrame, DataFrame]:
    """Model responses to typed rows and a table of rejects.

    Takes the text from the first ``[`` to the last ``]``, reads it as an array and
    coerces every item; a response that is no array or an item that misses a required
    field becomes a reject row.
    """
    # Items come out of one generator, whose results no filter can be moved below: else each
    # response would be read once for every condition on it. A response that is no array
    # gives one row without an item number.
    body = F.nullif(F.regexp_extract(response, r"(?s)\[.*\]", 0), F.lit(""))
    found = lambda items: F.when(items.isNotNull(), F.transform(items, lambda text, at: F.struct(
        at.alias("item_no"), text.alias("item_text"),
        F.when(text.rlike(r"(?s)^\s*\{"), F.from_json(text, RESPONSE_ITEM)).alias("item"),
    ))).otherwise(F.array(F.struct(
        F.lit(None).cast("int").alias("item_no"), F.col(response).alias("item_text"),
        F.from_json(F.lit(None).cast("string"), RESPONSE_ITEM).alias("item"))))
    items = df.select(*key, F.inline(bind(F.from_json(body, "array<string>"), found)))
    typed = coerce_assignment(items)
    rows = typed.filter(F.col("item_no").isNotNull() & F.col("reject_reason").isNull()).drop("reject_reason", "item", "item_text")
    reason = F.when(F.col("item_no").isNull(), "no JSON array").otherwise(F.col("reject_reason"))
    rejects = typed.filter(F.col("reject_reason").isNotNull()).select(
        *key, "item_no", reason.alias("reject_reason"), F.col("item_text").alias("source_text"))
    return rows, rejects


# --- page text -----------------------------------------------------------------------
def route_pages(pages: DataFrame, layer: str = "layer_text", scan: str = "scan_text",
                min_chars: int = K.MIN_READABLE_PER_PAGE,
                min_ratio: float = K.MIN_READABLE_RATIO) -> DataFrame:
    """Choose each page's text: the text layer, else the recognised scan.

    A scan below the readable ratio is kept at half confidence and marked for review;
    a page with no usable text has a null method.
    """
    clean = strip(F.coalesce(F.col(layer), F.lit("")))
    ocr = F.coalesce(F.col(scan), F.lit(""))
    out = pages.withColumns({"readable": readable_chars(clean), "_ratio": readable_ratio(ocr)})
    from_layer = F.col("readable") >= min_chars
    good_scan, some_scan = F.col("_ratio") >= min_ratio, strip(ocr) != ""
    return out.withColumns({
        "text": F.when(from_layer, clean).otherwise(ocr),
        "method": F.when(from_layer, "pypdf").when(good_scan | some_scan, "tesseract"),
        "confidence": F.when(
            from_layer, F.round(F.least(F.lit(1.0), F.col("readable") / (min_chars * 3)), 3)
        ).when(good_scan, F.round(F.col("_ratio") * 0.9, 3))
         .when(some_scan, F.round(F.col("_ratio") * 0.5, 3)),
        "needs_review": ~from_layer & ~good_scan,
    }).drop("_ratio")


def assemble_documents(pages: DataFrame, doc: str, page: str = "page_no") -> DataFrame:
    """Document text in page order, dominant method, mean confidence, pages per method.

    The pages of a document meet once; everything else is read off their array. Of
    equally frequent methods the one seen first wins.
    """
    used = pages.filter(F.col("method").isNotNull())
    # Decimal sums are exact, so the mean does not depend on the order of arrival.
    conf = F.col("confidence").cast("decimal(20,10)")
    whole = used.groupBy(doc).agg(
        F.array_sort(F.collect_list(F.struct(page, "text", "method"))).alias("_p"),
        F.sum(conf).alias("_conf"), F.count(F.lit(1)).alias("page_count"),
    )
    methods = F.array_distinct(F.transform("_p", lambda x: x["method"]))
    counted = F.transform(methods, lambda m, i: F.struct(
        F.size(F.filter("_p", lambda x: x["method"] == m)).cast("bigint").alias("n"), (-i).alias("first"), m.alias("method")))
    read = whole.withColumn("_m", counted)
    texts = F.filter(F.transform("_p", lambda x: x["text"]), lambda t: strip(t) != "")
    return read.select(
        doc,
        F.array_join(texts, "\n\n").alias("text"),
        F.array_max("_m")["method"].alias("method"),
        F.round(F.col("_conf").cast("double") / F.col("page_count"), 3).alias("confidence"),
        F.col("page_count").cast("int").alias("page_count"),
        F.map_from_entries(F.array_sort(F.transform("_m", lambda m: F.struct(m["method"], m["n"])))).alias("methods_used"),
    )


def scan_analysis(pages: DataFrame, doc: str, layer: str = "layer_text",
                  min_chars: int = K.MIN_READABLE_PER_PAGE) -> DataFrame:
    """Pages with and without a text layer, and what to do about the document."""
    has_text = readable_chars(strip(F.coalesce(F.col(layer), F.lit("")))) >= min_chars
    counts = pages.groupBy(doc).agg(
        F.count_if(has_text).alias("text_pages"), F.count_if(~has_text).alias("scan_pages")
    )
    mixed = F.format_string("Смешанный: %d текстовых + %d сканов", "text_pages", "scan_pages")
    return counts.withColumn(
        "recommendation",
        F.when(F.col("scan_pages") == 0, "pypdf (все страницы текстовые)")
        .when(F.col("text_pages") == 0, "Tesseract (все страницы — сканы)")
        .otherwise(mixed),
    )
