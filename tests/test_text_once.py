"""Texts, lines and model responses are read once, and only as far as a query asks."""

from pyspark.sql import functions as F

from decreta.operators import documents as Doc
from decreta.operators import extraction as X


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_model_response_is_parsed_once(spark):
    df = spark.range(3).selectExpr("id AS doc_id", """concat('[{"fio": "А", "rank_category": "КМС"}, ', id, ']') AS response""")
    for part, n in zip(Doc.parse_json_response(df, ["doc_id"], "response"), (3, 3)):
        # One for the array, one for an item.
        assert _plan(part).count("from_json(") == 2
        assert part.count() == n


def test_line_columns_that_nobody_asks_for_are_not_computed(spark):
    text = "№ ФИО\n1 Иванов Иван 01.02.1980 Бокс 10.02.2001\n2 Петров Пётр 01.02.1980 12345 Самбо 10.02.2001\nДОКУМЕНТ зарегистрирован"
    docs = spark.range(2).select(F.col("id").alias("doc_id"), F.concat(F.lit(text), F.col("id").cast("string")).alias("text"))
    rows = X.parse_table_lines(X.typed_lines(docs)).select("doc_id", "fio", "ias_id", "sport")
    assert "(?iuU)" not in _plan(rows)  # patterns of headers and footers
    assert sorted(map(tuple, rows.collect())) == [(d, *r) for d in (0, 1) for r in [("Иванов Иван", None, "Бокс"), ("Петров Пётр", 12345, "Самбо")]]
    kinds = X.typed_lines(docs).filter("doc_id = 0").orderBy("line_no")
    assert [r.kind for r in kinds.collect()] == ["lead", "row", "row", "skip"]


def test_a_free_entry_is_taken_apart_once(spark):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.concat(F.lit("Иванов Иван, 01.02.1980 г.р., КМС \x01 бокс\nПетров Пётр 02.02.1980 - МС"), F.col("id").cast("string")).alias("text"))
    entries = X.free_entries(docs)
    assert "regexp_extract(" not in _plan(entries)
    assert [(r.fio, r.birth_date_raw, r.context) for r in entries.orderBy("line_no").collect()] == [
        ("Иванов Иван", "01.02.1980", "КМС \x01 бокс"), ("Петров Пётр", "02.02.1980", "МС0")]
