"""Queries over document text, web pages and the derived order texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.pages import page_fingerprint
from decreta.functions.records import coerce_assignment
from decreta.operators import documents as Doc
from decreta.operators import extraction as X
from decreta.operators import links as Links
from decreta.operators import ordering as Ord
from decreta.operators import relational as R
from decreta.operators.matching import builtin_aliases
from decreta.plans import extract as E
from decreta.plans import orders as P
from decreta.plans.golden import expected_snapshot, golden_check, golden_diff
from decreta.plans.metrics import run_metrics, source_quality
from decreta.plans.normalize import normalize_ranks, normalize_sports
from decreta.queries import corpus
from decreta.queries.corpus import EXPECTED_SQL
from decreta.queries.model import table
from decreta.queries.scalar import _READABLE
from decreta.session import staged

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# --- documents -----------------------------------------------------------------------
@query("line_split", """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, trim(l[i]) AS line
FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE trim(l[i]) <> ''""")
def line_split(spark, d):
    return Doc.split_lines(table(spark, d, "documents"), ["doc_id"], "text")


@query("page_split", """
WITH pg AS (SELECT conv_id, turn, text, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations)
SELECT conv_id, CAST(n AS INTEGER) AS page_no, text AS page_text FROM pg""")
def page_split(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", F.struct("turn", "text").alias("t"))
    footer = "\nДокумент зарегистрирован № 7\nСтраница 1 из 9. Создана\n"
    docs = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select(
        "conv_id", F.array_join(F.transform("t", lambda x: F.concat(x["text"], F.lit(footer))), "").alias("text"))
    return Doc.split_pages(docs, "conv_id", "text")


_PAGES_SQL = f"""pg AS (SELECT conv_id AS doc_id, turn AS page_no, text, CASE WHEN role = 'user' THEN 'pypdf' ELSE 'tesseract' END AS method,
  ROUND(LEAST(1.0, length(regexp_replace(text, '{_READABLE}', '', 'g')) / 240.0), 3) AS confidence FROM conversations)"""


@query("document_assembly", "WITH " + _PAGES_SQL + """,
m AS (SELECT doc_id, method, COUNT(*) AS n, MIN(page_no) AS first FROM pg GROUP BY ALL),
top AS (SELECT doc_id, method FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS rn FROM m) WHERE rn = 1)
SELECT pg.doc_id, sha256(string_agg(text, chr(10) || chr(10) ORDER BY page_no)) AS text_hash, MAX(top.method) AS method,
  ROUND(CAST(SUM(CAST(confidence AS DECIMAL(20, 10))) AS DOUBLE) / COUNT(*), 3)::DOUBLE AS confidence, CAST(COUNT(*) AS INTEGER) AS page_count, COUNT(*) FILTER (WHERE pg.method = 'pypdf') AS layer_pages
FROM pg JOIN top ON pg.doc_id = top.doc_id GROUP BY pg.doc_id""")
def document_assembly(spark, d):
    from decreta.functions.text import readable_chars
    pages = table(spark, d, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text",
        F.when(F.col("role") == "user", "pypdf").otherwise("tesseract").alias("method"),
        F.round(F.least(F.lit(1.0), readable_chars(F.col("text")) / 240), 3).alias("confidence"))
    return Doc.assemble_documents(pages, "doc_id").select(
        "doc_id", F.sha2("text", 256).alias("text_hash"), "method", "confidence", "page_count",
        F.coalesce(F.try_element_at("methods_used", F.lit("pypdf")), F.lit(0)).alias("layer_pages"))


@query("scan_analysis", f"""
SELECT conv_id, t AS text_pages, s AS scan_pages, CASE WHEN s = 0 THEN 'pypdf (все страницы текстовые)' WHEN t = 0 THEN 'Tesseract (все страницы — сканы)'
  ELSE 'Смешанный: ' || t || ' текстовых + ' || s || ' сканов' END AS recommendation FROM (
 SELECT conv_id, COUNT(*) FILTER (WHERE n >= 80) AS t, COUNT(*) FILTER (WHERE n < 80) AS s FROM (
  SELECT conv_id, length(regexp_replace(trim(text), '{_READABLE}', '', 'g')) AS n FROM conversations) GROUP BY conv_id)""")
def scan_analysis(spark, d):
    return Doc.scan_analysis(table(spark, d, "conversations").withColumnRenamed("text", "layer_text"), "conv_id")


@query("chunk_invariants", r"""
WITH RECURSIVE cuts AS (
  SELECT doc_id, text, 0 AS k, 0 AS a, 0 AS b FROM documents
  UNION ALL SELECT doc_id, text, k + 1, b, CASE WHEN length(text) - b <= 400 THEN length(text)
    WHEN strpos(reverse(substr(text, b + 1, 400)), chr(10) || chr(10)) > 0 THEN b + 401 - strpos(reverse(substr(text, b + 1, 400)), chr(10) || chr(10))
    WHEN strpos(reverse(substr(text, b + 1, 400)), chr(10)) > 0 THEN b + 401 - strpos(reverse(substr(text, b + 1, 400)), chr(10))
    ELSE b + 400 END FROM cuts WHERE b < length(text))
SELECT d.doc_id, CAST(greatest(1, count(c.k)) AS BIGINT) AS n_chunks, CAST(coalesce(max(c.b - c.a), 0) AS BIGINT) AS longest,
  coalesce(string_agg(c.b, ',' ORDER BY c.k), '0') AS ends, sha256(d.text) AS joined
FROM documents d LEFT JOIN cuts c ON c.doc_id = d.doc_id AND c.k > 0 GROUP BY d.doc_id, d.text""")
def chunk_invariants(spark, d):
    """Number, longest, ends, and the text that the chunks give together."""
    chunks = Doc.chunk_text(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", 400)
    per = chunks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk_no", "chunk"))).alias("c"))
    sizes = F.transform("c", lambda x: F.length(x["chunk"]))
    ends = F.transform(sizes, lambda n, i: F.aggregate(F.slice(sizes, F.lit(1), i + 1), F.lit(0), lambda a, b: a + b))
    return per.select("doc_id", F.size("c").cast("bigint").alias("n_chunks"), F.array_max(sizes).cast("bigint").alias("longest"),
                      F.array_join(ends.cast("array<string>"), ",").alias("ends"),
                      F.sha2(F.array_join(F.transform("c", lambda x: x["chunk"]), ""), 256).alias("joined"))


@query("award_lines", r"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, regexp_extract(h[i], '([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\s*-\s*(.+)', 1) AS name,
  trim(regexp_extract(h[i], '([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\s*-\s*(.+)', 2)) AS award
FROM (SELECT doc_id, h, unnest(range(1, len(h) + 1)) AS i FROM (
  SELECT doc_id, regexp_extract_all(replace(text, '. ', ' - '), '[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s*-\s*.+') AS h FROM documents))""")
def award_lines(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.replace("text", F.lit(". "), F.lit(" - ")).alias("text"))
    return Doc.parse_awards(docs, "doc_id", "text", r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\s*-\s*(.+)")


# --- headings, marks, line states -----------------------------------------------------
@query("heading_fill", """
WITH x AS (SELECT user_id, event_id, CASE WHEN event_type = 'signup' THEN 'h' || event_id END AS heading FROM events)
SELECT user_id, event_id, last_value(heading IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM x""")
def heading_fill(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "event_type")
    heading = F.when(F.col("event_type") == "signup", F.concat(F.lit("h"), "event_id"))
    return Ord.forward_fill(rows, ["user_id"], "event_id", heading, "section", chunk_rows=1000).select("user_id", "event_id", "section")


@query("repeat_marks", """
WITH x AS (SELECT l_orderkey, l_partkey, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS pos FROM lineitem),
y AS (SELECT l_orderkey, CAST(pos AS INTEGER) AS pos, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'sport ' || l_partkey END AS v FROM x)
SELECT l_orderkey, pos, COALESCE(last_value(v IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '-«-') AS sport FROM y""")
def repeat_marks(spark, d):
    rows = corpus.order_rows(spark, d).select("l_orderkey", F.posexplode("rows").alias("pos", "r")).select(
        "l_orderkey", "pos",
        F.when(F.col("r.p") % 3 == 0, "-«-").otherwise(F.concat(F.lit("sport "), F.col("r.p"))).alias("sport"))
    return Ord.fill_repeat_marks(rows, ["l_orderkey"], "pos", "sport", K.REPEAT_MARK, chunk_rows=50)


@query("category_block_lines", "WITH " + EXPECTED_SQL + """
SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN 0 ELSE COUNT(*) END AS data_rows, CASE WHEN doc_id % 3 = 0 THEN 2 * COUNT(*) ELSE 0 END AS block_lines FROM ln GROUP BY doc_id""")
def category_block_lines(spark, d):
    lines = X.typed_lines(corpus.order_texts(spark, d))
    marked = X.category_lines(lines)
    return marked.groupBy("doc_id").agg(F.count_if(F.col("kind") == "row").alias("data_rows"),
                                        F.count_if("in_block").alias("block_lines"))


# --- extraction -----------------------------------------------------------------------------
@query("table_line_fields", "WITH " + EXPECTED_SQL + """
SELECT doc_id, CAST(i AS INTEGER) AS row_num, fio, strftime(birth, '%d.%m.%Y') AS birth_date_raw,
  CASE WHEN doc_id % 3 = 2 THEN 'прочее' WHEN lowered THEN lower(sport) ELSE sport END AS sport, '10.02.2001' AS submission_date
FROM f WHERE doc_id % 3 <> 1""")
def table_line_fields(spark, d):
    lines = X.typed_lines(corpus.order_texts(spark, d))
    return X.parse_table_lines(lines).select("doc_id", "row_num", "fio", "birth_date_raw", "sport", "submission_date")


@query("category_pairs", "WITH " + EXPECTED_SQL + """
SELECT doc_id, fio, CASE WHEN doc_id % 3 = 0 THEN 'Спортивный судья ' || judge || ' категории' END AS rank_text FROM f WHERE doc_id % 3 <> 1""")
def category_pairs(spark, d):
    """The i-th data row of a page with the i-th two-line category."""
    lines = X.typed_lines(corpus.order_texts(spark, d))
    return X.table_rows(lines).select("doc_id", "fio", "rank_text")


@query("section_sports", "WITH " + EXPECTED_SQL + """
SELECT doc_id, fio, CASE WHEN lowered AND doc_id % 3 = 0 THEN lower(sport) ELSE sport END AS sport FROM f WHERE doc_id % 3 <> 1""")
def section_sports(spark, d):
    from decreta.operators.matching import match_names
    # Only documents with section rows are asked for headings, as in extraction. Their
    # lines are read once, for the headings and for the rows.
    typed = corpus.order_texts(spark, d).select("doc_id", X.typed_line_array(F.col("text")).alias("lines"))
    typed = typed.filter(F.exists("lines", lambda x: x["section_row"]))
    lines = staged(typed.select("doc_id", F.inline(F.filter("lines", lambda x: x["section_row"] | x["heading_candidate"]))), "section-lines")
    heads = lines.filter("heading_candidate").select(F.col("line").alias("name"))
    found = staged(match_names(heads, corpus.sport_registry(spark), builtin_aliases(spark), complete=False).filter(
        (F.col("confidence") >= K.SECTION_MATCH) & F.col("canonical_name").isNotNull()), "headings")
    headings = found.select(F.col("input_name").alias("line"), F.col("canonical_name").alias("heading_sport"))
    return X.section_rows(lines, headings).select("doc_id", "fio", "sport")


@query("free_text_rows", "WITH " + EXPECTED_SQL + """
SELECT doc_id, fio, strftime(birth, '%d.%m.%Y') AS birth_date_raw, CASE WHEN doc_id % 3 = 1 THEN rank END AS rank_category FROM f""")
def free_text_rows(spark, d):
    rank = F.when(F.col("doc_id") % 3 == 1, X.rank_in_text(F.col("context")))
    return X.free_entries(corpus.order_texts(spark, d)).select("doc_id", "fio", "birth_date_raw", rank.alias("rank_category"))


@query("context_sports", "WITH " + EXPECTED_SQL + """
SELECT * FROM (SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, CASE WHEN doc_id % 3 = 2 THEN lead(sport) OVER (PARTITION BY doc_id ORDER BY i) ELSE sport END AS sport FROM f) WHERE sport IS NOT NULL""")
def context_sports(spark, d):
    from decreta.operators.matching import match_names
    phrases = staged(X.context_phrases(X.free_entries(corpus.order_texts(spark, d))), "phrases")
    found = staged(match_names(phrases.select("name"), corpus.sport_registry(spark), builtin_aliases(spark), complete=False), "matches")
    return X.first_context_sport(phrases, found)


_EXTRACTED = "WITH " + EXPECTED_SQL + """
SELECT doc_id, CAST(row_no AS INTEGER) AS row_no, layout, fio, strftime(birth, '%d.%m.%Y') AS birth_date_raw,
  CASE WHEN doc_id % 3 = 2 AND layout = 'table' THEN 'прочее' ELSE sport END AS sport,
  CASE layout WHEN 'free' THEN rank WHEN 'table' THEN CASE WHEN doc_id % 3 = 0 THEN 'спортивный судья ' || judge || ' категории' ELSE '' END ELSE '' END AS rank_category,
  CASE WHEN doc_id % 3 = 0 THEN 'judge_category' ELSE 'sport_rank' END AS assignment_type,
  CASE WHEN doc_id % 3 = 1 THEN 'confirmation' ELSE 'assignment' END AS action,
  CASE layout WHEN 'free' THEN 0.7 WHEN 'section' THEN 0.75 ELSE CASE WHEN doc_id % 3 = 0 THEN 0.89 ELSE 0.67 END END::DOUBLE AS confidence,
  date_diff('day', birth, order_date) / 365.25 < 5 AS suspicious FROM expected"""


@query("extract_assignments", _EXTRACTED)
def extract_assignments(spark, d):
    """Extraction of every order text against the rows it was made of."""
    rows = E.extract_assignments(corpus.order_texts(spark, d), corpus.sport_registry(spark), builtin_aliases(spark))
    return rows.select("doc_id", "row_no", "layout", "fio", "birth_date_raw", "sport", "rank_category", "assignment_type",
                       "action", "confidence", F.map_contains_key("extra_fields", "birth_date_suspicious").alias("suspicious"))


@query("post_process", """
WITH x AS (SELECT l_orderkey AS doc_id, l_suppkey % 3 AS who, l_partkey % 2 AS born, MIN(l_linenumber * 1000000 + l_partkey) AS first
  FROM lineitem GROUP BY ALL)
SELECT doc_id, CASE who WHEN 0 THEN 'Иванов Иван' ELSE 'Шолин Максим' END AS fio, CASE born WHEN 0 THEN '01.02.1980' ELSE '01.02.1901' END AS birth_date_raw,
  CASE born WHEN 0 THEN 0.9 ELSE 0.6 END::DOUBLE AS confidence, CAST(first AS BIGINT) AS first FROM x WHERE who <> 2""")
def post_process(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(
        "l_orderkey AS doc_id", "1 AS page_no", "l_linenumber * 1000000 + l_partkey AS line_no",
        "element_at(array('Иванов Иван', 'ШолинМаксим', 'Список лиц'), CAST(l_suppkey % 3 + 1 AS INT)) AS fio",
        "CASE WHEN l_partkey % 2 = 0 THEN '01.02.1980' ELSE '01.02.1901' END AS birth_date_raw", "CAST(0.9 AS DOUBLE) AS confidence",
        "map('parse_method', 'rule_based') AS extra_fields", "DATE '2001-01-01' AS order_date")
    return X.post_process(X.with_birth_date(rows)).select("doc_id", "fio", "birth_date_raw", "confidence", F.col("line_no").cast("bigint").alias("first"))


@query("normalize_sports_and_ranks", "WITH " + EXPECTED_SQL + """
SELECT doc_id, CAST(i AS INTEGER) AS i, sport, CASE WHEN lowered THEN lower(sport) END AS sport_original,
  CASE WHEN lowered THEN 'case_norm' ELSE 'exact' END AS match_method, CASE WHEN lowered THEN 0.95 ELSE 1.0 END::DOUBLE AS match_confidence, rank AS rank_category,
  CASE CAST(s AS BIGINT) % 4 WHEN 1 THEN 'II спортивный разряд' WHEN 2 THEN 'КМС' END AS rank_category_original FROM f""")
def normalize_sports_and_ranks(spark, d):
    f = corpus._FIELDS
    rows = corpus.order_rows(spark, d).select("l_orderkey", F.posexplode("rows").alias("pos", "r")).selectExpr(
        "l_orderkey AS doc_id", "pos + 1 AS i", f"{f['sport']} AS sport", f"{f['rank']} AS rank_category", "CAST(NULL AS STRING) AS sport_original")
    out = normalize_sports(normalize_ranks(rows), corpus.sport_registry(spark), builtin_aliases(spark))
    return out.select("doc_id", "i", "sport", "sport_original", "match_method", "match_confidence", "rank_category", "rank_category_original")


# Written name, stored name, how it is found.
_SPELLINGS = [
    ("Бокс", "Бокс", "exact"), ("дзюдо", "Дзюдо", "case_norm"), ("Спортиваня акробатика", "Спортивная акробатика", "alias"),
    ("Автомобильный спортт", "Автомобильный спорт", "fuzzy"), ("Неведомое дело", None, "not_found"),
]


@query("normalize_sport_spellings", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(
    "CASE CAST(l_partkey AS BIGINT) % 5 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v) + f" END AS {name}"
    for name, values in (("sport", [s[1] or s[0] for s in _SPELLINGS]), ("sport_original", [s[0] if s[1] and s[1] != s[0] else None for s in _SPELLINGS]),
                         ("match_method", [s[2] for s in _SPELLINGS]))) + " FROM lineitem")
def normalize_sport_spellings(spark, d):
    """Sports of all rows in five spellings: exact, other case, alias, misspelt, unknown."""
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.element_at(F.array(*[F.lit(s[0]) for s in _SPELLINGS]), (F.col("l_partkey") % 5 + 1).cast("int")).alias("sport"),
        F.lit(None).cast("string").alias("sport_original"))
    out = normalize_sports(rows, corpus.sport_registry(spark), builtin_aliases(spark))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "sport", "sport_original", "match_method")


_QUEUE = """q AS (
  SELECT o_orderkey AS id, o_orderkey % 3 AS source_id, url, n.records, n.matched, CASE WHEN url IS NULL THEN 'Нет URL для скачивания'
    WHEN url LIKE '%elsewhere%' THEN 'URL заблокирован (SSRF): ' || url WHEN n.records IS NULL THEN 'Текст документа не получен' END AS error
  FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'https://elsewhere.example.org/a.pdf' WHEN o_orderkey % 13 = 0 THEN NULL
          ELSE 'https://host.example.org/a.pdf' END AS url FROM orders WHERE o_orderstatus = 'P')
  LEFT JOIN (SELECT doc_id, COUNT(*) AS records, COUNT(*) FILTER (WHERE doc_id % 3 <> 2 OR layout = 'section') AS matched
             FROM expected GROUP BY doc_id) n ON n.doc_id = o_orderkey)"""
# Section pages that are read as tables have a sport outside the registry in every row.
_STEPS = "WITH " + EXPECTED_SQL + ",\n" + _QUEUE + """,
steps AS (
  SELECT id, source_id, 'download' AS stage, url IS NULL OR url LIKE '%elsewhere%' AS failed, error, NULL AS records, NULL AS matched, NULL AS unmatched FROM q
  UNION ALL SELECT id, source_id, 'ocr', records IS NULL, error, NULL, NULL, NULL FROM q WHERE url LIKE '%//host%'
  UNION ALL SELECT id, source_id, 'extract', FALSE, NULL, NULL, NULL, NULL FROM q WHERE error IS NULL
  UNION ALL SELECT id, source_id, 'normalize', FALSE, NULL, NULL, matched, records - matched FROM q WHERE error IS NULL
  UNION ALL SELECT id, source_id, 'save', FALSE, NULL, records, NULL, NULL FROM q WHERE error IS NULL)
"""


def _processed(spark, d):
    """All pending orders from policy check to stored rows, statuses and log; and the orders."""
    src = spark.createDataFrame([(0, "moskva_tstisk"), (1, "free"), (2, "section")], "id int, code string")
    pending = table(spark, d, "orders").filter("o_orderstatus = 'P'").selectExpr(
        "o_orderkey AS id", "CAST(o_orderkey % 3 AS INT) AS source_id", "concat('N-', o_orderkey) AS order_number",
        "CAST(o_orderdate AS DATE) AS order_date", "'new' AS status", "o_orderdate AS created_at",
        """CASE WHEN o_orderkey % 11 = 0 THEN 'https://elsewhere.example.org/a.pdf' WHEN o_orderkey % 13 = 0 THEN NULL
           ELSE 'https://host.example.org/a.pdf' END AS file_url""", "CAST(NULL AS STRING) AS source_url", "CAST(NULL AS STRING) AS file_hash")
    texts = corpus.order_texts(spark, d, "o_orderstatus = 'P'", {"file_hash": "sha2(concat(doc_id, text), 256)"}).selectExpr(
        "doc_id AS order_id", "text", "file_hash", "1 AS page_count", "'pypdf' AS ocr_method", "1.0D AS ocr_confidence")
    hosts = spark.createDataFrame([("host.example.org",)], "host string")
    done = P.process_orders(pending, texts, src, hosts, corpus.sport_registry(spark), builtin_aliases(spark), F.current_timestamp())
    return pending, done


@query("process_orders", "WITH " + EXPECTED_SQL + """,
n AS (SELECT doc_id, COUNT(*) AS records FROM expected GROUP BY doc_id),
q AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN 'https://elsewhere.example.org/a.pdf' WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'https://host.example.org/a.pdf' END AS url
      FROM orders WHERE o_orderstatus = 'P')
SELECT q.id, CASE WHEN url IS NULL OR url LIKE '%elsewhere%' OR n.records IS NULL THEN 'failed' ELSE 'extracted' END AS status,
  CASE WHEN url IS NULL OR url LIKE '%elsewhere%' THEN 0 ELSE COALESCE(n.records, 0) END AS records,
  CASE WHEN url IS NULL THEN 'Нет URL для скачивания' WHEN url LIKE '%elsewhere%' THEN 'URL заблокирован (SSRF): ' || url WHEN n.records IS NULL THEN 'Текст документа не получен' END AS error
FROM q LEFT JOIN n ON n.doc_id = q.id""")
def process_orders(spark, d):
    return _processed(spark, d)[1].results.select("id", "status", "records", "error")


@query("process_log", _STEPS + """
SELECT id AS order_id, source_id, stage, CASE WHEN failed THEN 'error' ELSE 'info' END AS level, CASE WHEN failed THEN error END AS error,
  records, matched, unmatched, stage IN ('download', 'extract', 'save') AS timed FROM steps""")
def process_log(spark, d):
    """The log that processing wrote: every step of every order, up to the one that failed."""
    number = lambda key: F.col("details")[key].try_cast("bigint").alias(key)
    return _processed(spark, d)[1].log.select(
        "order_id", "source_id", "stage", "level", F.when(F.col("level") == "error", F.col("message")).alias("error"),
        number("records"), number("matched"), number("unmatched"),
        F.coalesce(F.col("details")["duration_ms"].try_cast("bigint") >= 0, F.lit(False)).alias("timed"))


@query("process_run_metrics", _STEPS + """
SELECT id AS order_id, COUNT(*) AS steps, COUNT(*) FILTER (WHERE failed) AS failed_steps, MAX(records) AS records,
  CAST(SUM(matched) AS BIGINT) AS matched, CAST(SUM(unmatched) AS BIGINT) AS unmatched, TRUE AS timed
FROM steps GROUP BY id""")
def process_run_metrics(spark, d):
    """Metrics of each order over the log of its processing."""
    return run_metrics(_processed(spark, d)[1].log).select(
        "order_id", "steps", "failed_steps", "records", "matched", "unmatched", (F.col("duration_ms") >= 0).alias("timed"))


@query("process_source_quality", _STEPS + """
SELECT CAST(source_id AS INTEGER) AS source_id, ROUND(AVG(CASE WHEN error IS NULL THEN 1.0 ELSE 0.0 END), 6) AS coverage,
  ROUND(AVG(CASE WHEN error IS NULL THEN records ELSE 0 END), 6) AS avg_row_yield,
  ROUND(AVG(CASE WHEN url IS NULL OR url LIKE '%elsewhere%' THEN 1.0 ELSE 0.0 END), 6) AS link_rot_rate, CAST(COUNT(*) AS INTEGER) AS sample_size
FROM q GROUP BY source_id""")
def process_source_quality(spark, d):
    """Quality per source over processed orders, their rows and the log of the run."""
    pending, done = _processed(spark, d)
    orders = pending.select("id", "source_id").join(done.updates, "id")
    figures = source_quality(orders, done.rows, done.log)
    return figures.select("source_id", *[F.round(c, 6).alias(c) for c in ("coverage", "avg_row_yield", "link_rot_rate")], "sample_size")


@query("process_steps", _STEPS + """
SELECT 'download' AS stage, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE url IS NULL OR url LIKE '%elsewhere%' OR records IS NULL) AS failed, NULL AS matched FROM q
UNION ALL SELECT 'extract', CAST(SUM(records) FILTER (WHERE error IS NULL) AS BIGINT), NULL, CAST(SUM(matched) FILTER (WHERE error IS NULL) AS BIGINT) FROM q
UNION ALL SELECT 'save', COUNT(*), COUNT(*) FILTER (WHERE error IS NOT NULL), NULL FROM q""")
def process_steps(spark, d):
    """Rows of each step of the run as observed while they were written."""
    counted = lambda key: F.try_element_at("counts", F.lit(key))
    return _processed(spark, d)[1].steps.select(
        "stage", counted("rows").alias("n_rows"), counted("failed").alias("failed"), counted("matched").alias("matched"))


# --- golden sets -----------------------------------------------------------------------------
@query("golden_check", """
WITH a AS (SELECT l_orderkey AS doc_id, COUNT(*) AS n FROM lineitem GROUP BY 1),
e AS (SELECT doc_id, n + CASE WHEN doc_id % 5 = 0 THEN 3 WHEN doc_id % 7 = 0 THEN -9 ELSE 0 END AS n FROM a WHERE doc_id % 17 <> 0)
SELECT a.doc_id, COALESCE(e.n, 0) AS expected_count, a.n AS actual_count, a.n - COALESCE(e.n, 0) AS delta, a.n = COALESCE(e.n, 0) AS "match",
  CASE WHEN abs(a.n - COALESCE(e.n, 0)) <= 2 THEN 'pass' WHEN abs(a.n - COALESCE(e.n, 0)) <= 5 THEN 'warn' ELSE 'fail' END AS status FROM a LEFT JOIN e USING (doc_id)""")
def golden_check_query(spark, d):
    rows = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "doc_id")
    actual = expected_snapshot(rows).withColumn("record_count", F.col("record_count").cast("bigint"))
    shift = F.expr("CASE WHEN doc_id % 5 = 0 THEN 3 WHEN doc_id % 7 = 0 THEN -9 ELSE 0 END")
    expected = actual.filter("doc_id % 17 <> 0").withColumn("record_count", F.col("record_count") + shift)
    return golden_check(expected, actual)


@query("golden_row_diff", """
SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 10 = 0 THEN 'missing' WHEN p_partkey % 10 = 1 THEN 'unexpected' ELSE 'changed' END AS change,
  CASE WHEN p_partkey % 10 IN (0, 1) THEN NULL WHEN p_partkey % 10 = 2 THEN 'sport' ELSE 'sport,rank' END AS fields FROM part WHERE p_partkey % 10 < 4""")
def golden_row_diff(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("sport"), F.col("p_brand").alias("rank"))
    k = F.col("doc_id") % 10
    changed = part.withColumns({"sport": F.when(k.isin(2, 3), F.concat("sport", F.lit("!"))).otherwise(F.col("sport")),
                                "rank": F.when(k == 3, "x").otherwise(F.col("rank"))})
    diff = golden_diff(part.filter(k != 1), changed.filter(k != 0), ["doc_id"], ["sport", "rank"])
    return diff.select("doc_id", "change", F.array_join("fields", ",").alias("fields"))


# --- model responses --------------------------------------------------------------------------
_RESPONSE = """concat('Here:\\n```json\\n[', array_join(transform(rows, r -> CASE WHEN r.p % 6 = 0 THEN '7' ELSE to_json(named_struct(
  'fio', concat('-', 'Person ', r.s), 'birth_date', CASE WHEN r.p % 2 = 0 THEN '1990-05-01' ELSE '01.05.1990 г.' END, 'ias_id', CASE WHEN r.p % 4 = 0 THEN 'none' ELSE CAST(r.p AS STRING) END,
  'rank_category', CASE WHEN r.p % 5 = 0 THEN ' ' ELSE 'КМС' END, 'assignment_type', CASE WHEN r.p % 3 = 0 THEN 'odd' ELSE 'judge_category' END,
  'sport', 'Бокс', 'sport_original', 'Бокс', 'extra_fields', map('position', 'x', 'department', ''))) END), ', '), ']\\n```')"""


@query("model_response_rows", """
SELECT l_orderkey AS doc_id, 'Person ' || l_suppkey AS fio, '01.05.1990' AS birth_date_raw, CASE WHEN l_partkey % 4 <> 0 THEN CAST(l_partkey AS INTEGER) END AS ias_id,
  CASE WHEN l_partkey % 3 = 0 THEN 'sport_rank' ELSE 'judge_category' END AS assignment_type, CAST(NULL AS VARCHAR) AS sport_original, 'assignment' AS action, 'position' AS extra_keys
FROM lineitem WHERE l_partkey % 6 <> 0 AND l_partkey % 5 <> 0""")
def model_response_rows(spark, d):
    rows, _ = Doc.parse_json_response(corpus.order_rows(spark, d).selectExpr("l_orderkey AS doc_id", f"{_RESPONSE} AS response"), ["doc_id"], "response")
    return rows.select("doc_id", "fio", "birth_date_raw", "ias_id", "assignment_type", "sport_original", "action",
                       F.array_join(F.map_keys("extra_fields"), ",").alias("extra_keys"))


@query("model_response_rejects", """
SELECT l_orderkey AS doc_id, CASE WHEN l_partkey % 6 = 0 THEN 'not an object' ELSE 'empty rank' END AS reject_reason FROM lineitem WHERE l_partkey % 6 = 0 OR l_partkey % 5 = 0""")
def model_response_rejects(spark, d):
    _, rejects = Doc.parse_json_response(corpus.order_rows(spark, d).selectExpr("l_orderkey AS doc_id", f"{_RESPONSE} AS response"), ["doc_id"], "response")
    return rejects.select("doc_id", "reject_reason")


@query("coerce_items", """
SELECT event_id, CAST(user_id AS INTEGER) AS ias_id, CASE WHEN event_type = 'error' THEN 'refusal' ELSE 'assignment' END AS action FROM events""")
def coerce_items(spark, d):
    items = table(spark, d, "events").selectExpr("event_id", """named_struct('fio', concat(event_type, ' name'), 'birth_date', '01.02.1990', 'ias_id', CAST(user_id AS STRING),
        'submission_number', '', 'assignment_type', event_type, 'rank_category', 'КМС', 'sport', '', 'sport_original', '',
        'action', CASE event_type WHEN 'error' THEN 'refusal' ELSE event_type END, 'extra_fields', map('k', props)) AS item""")
    return coerce_assignment(items).filter(F.col("reject_reason").isNull()).select("event_id", "ias_id", "action")


# --- pages and links ----------------------------------------------------------------------------
_LINKS_SQL = r"""lk AS (SELECT page_id, url AS page_url, CAST(i - 1 AS INTEGER) AS pos, h[i] AS href, regexp_extract(url, '^(https?://[^/]*)', 1) || h[i] AS url FROM (
  SELECT page_id, url, h, unnest(range(1, len(h) + 1)) AS i FROM (
    SELECT page_id, url, list_filter(m, lambda x, k: list_position(m, x) = k) AS h FROM (
      SELECT page_id, url, regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1) AS m FROM pages))))"""


def _links(spark, d, context=False):
    return Links.extract_links(table(spark, d, "pages"), K.HREF_ANY, ("page_id",), context=context)


@query("page_links", "WITH " + _LINKS_SQL + " SELECT page_id, pos, href, url FROM lk")
def page_links(spark, d):
    return _links(spark, d).select("page_id", "pos", "href", "url")


@query("link_context", "WITH " + _LINKS_SQL + r""",
c AS (SELECT lk.page_id, lk.pos, strpos(p.html, '"' || lk.href || '"') + 1 AS spot, p.html FROM lk JOIN pages p ON p.page_id = lk.page_id),
x AS (SELECT page_id, pos, substr(html, GREATEST(spot - 500, 1), spot + 500 - GREATEST(spot - 500, 1)) AS ctx FROM c)
SELECT page_id, pos, sha256(ctx) AS context_hash, COALESCE(NULLIF(regexp_extract(ctx, '[№N][\t\n\r \x{a0}]*([А-Яа-яA-Za-z0-9\-/]+)', 1), ''), '') AS order_number, 'приказ' AS order_type FROM x""")
def link_context(spark, d):
    return _links(spark, d, True).select("page_id", "pos", F.sha2("context", 256).alias("context_hash"), "order_number", "order_type")


@query("first_seen_links", "WITH " + _LINKS_SQL + """
SELECT url, page_id, pos FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY url ORDER BY page_id, pos) AS rn FROM lk) WHERE rn = 1""")
def first_seen_links(spark, d):
    return R.first_links(_links(spark, d), ["url"], F.col("page_id"), F.col("pos")).select("url", "page_id", "pos")


@query("document_links", "WITH " + _LINKS_SQL + r""",
w AS (SELECT page_id, pos, url || CASE pos % 3 WHEN 0 THEN '.PDF' WHEN 1 THEN '/media/docs/1' ELSE '' END AS url FROM lk)
SELECT page_id, pos, url FROM w WHERE (lower(url) LIKE '%.pdf%' OR lower(url) LIKE '%/media/docs/%') AND regexp_matches(url, '(?i)/[a-t]')""")
def document_links(spark, d):
    links = _links(spark, d).withColumn("url", F.concat("url", F.expr("CASE pos % 3 WHEN 0 THEN '.PDF' WHEN 1 THEN '/media/docs/1' ELSE '' END")))
    return R.document_links(links, "url", "/[a-t]").select("page_id", "pos", "url")


@query("link_groups", "WITH " + _LINKS_SQL + """
SELECT page_url, url, CASE WHEN pos > 0 THEN first_value(url) OVER (PARTITION BY page_url ORDER BY pos) END AS parent_url, CASE WHEN pos > 0 THEN pos END AS attachment_num FROM lk""")
def link_groups(spark, d):
    return Links.group_attachments(_links(spark, d), F.col("page_id"))


@query("new_links", "WITH " + _LINKS_SQL + """,
known AS (SELECT DISTINCT 's' || page_id % 5 AS source_code, url FROM lk WHERE page_id % 2 = 0)
SELECT 's' || lk.page_id % 5 AS source_code, lk.page_id, lk.pos, lk.url FROM lk WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.url = lk.url AND k.source_code = 's' || lk.page_id % 5)""")
def new_links(spark, d):
    links = _links(spark, d).withColumn("source_code", F.concat(F.lit("s"), F.col("page_id") % 5))
    known = links.filter("page_id % 2 = 0").select("source_code", F.col("url").alias("source_url"), F.col("file_url"))
    return R.new_documents(links, known).select("source_code", "page_id", "pos", "url")


@query("embedded_json", r"""
SELECT page_id, CAST(k AS INTEGER) AS pos, regexp_extract(url, '^(https?://[^/]*)', 1) || '/doc/' || page_id || '-' || k AS url, 'T' || k AS title, 'N' || page_id AS order_number
FROM pages, range(3) t(k)""")
def embedded_json(spark, d):
    doc = "concat('{\"url\": \"/doc/', page_id, '-', k, '\", \"title\": \"T', k, '\", \"order_number\": \"N', page_id, '\"}')"
    listed = f"array_join(transform(sequence(0, 2), k -> {doc}), ', ')"
    html = f"""concat(html, '<script>var $obj = ', CASE page_id % 2 WHEN 0 THEN concat('[', {listed}, ']') ELSE concat('{{"data": [', {listed}, ']}}') END, ';</script>') AS html"""
    pages = table(spark, d, "pages").selectExpr("page_id", "url", html)
    return Links.extract_embedded_json(pages, "$obj", ("page_id",)).select("page_id", "pos", "url", "title", "order_number")


@query("hash_changes", """
WITH s AS (SELECT p.page_id, k AS snap, sha256(regexp_replace(html, '[^a-z]', '', 'g') || CASE WHEN k % 2 = 1 AND p.page_id % 3 = 0 THEN 'new' ELSE '' END) AS h FROM pages p, range(4) t(k))
SELECT page_id, CAST(snap AS INTEGER) AS snap, CASE WHEN lag(h) OVER w IS NULL THEN 'first' WHEN lag(h) OVER w = h THEN 'unchanged' ELSE 'changed' END AS change
FROM s WINDOW w AS (PARTITION BY page_id ORDER BY snap)""")
def hash_changes(spark, d):
    snaps = table(spark, d, "pages").select("page_id", "html", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("snap"))
    body = F.when((F.col("snap") % 2 == 1) & (F.col("page_id") % 3 == 0), F.concat("html", F.lit("new"))).otherwise(F.col("html"))
    snaps = snaps.select("page_id", "snap", F.expr("TIMESTAMP_NTZ'2024-01-20 00:00:00' + make_dt_interval(snap * 7)").alias("seen_at"),
                         page_fingerprint(body).alias("page_hash"))
    return Ord.change_status(snaps, "page_id", "seen_at", "page_hash").select("page_id", "snap", "change")
