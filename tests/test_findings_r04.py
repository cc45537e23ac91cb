"""What a review of larger tables found: joins that copied a side with a row for every order."""

from pyspark.sql import functions as F

from decreta.operators.relational import not_stored
from decreta.plans.extract import extract_assignments
from decreta.plans.orders import process_orders
from decreta.sources.store import Store

ROW = "{} Иванов Иван Иванович 0{}.02.1980 Бокс 10.02.2001\n"
TEXT = "О присвоении квалификационных категорий спортивных судей\n" + "".join(ROW.format(i, i) for i in (1, 2, 3))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_all_orders_are_not_broadcast(spark, tmp_path):
    """Files of equal texts and running ids are small, their rows in memory are not."""
    spark.range(50).select(F.col("id").cast("string").alias("order_id"), F.lit(TEXT).alias("text"), F.col("id").cast("string").alias("file_hash")).write.parquet(str(tmp_path / "t"))
    landed = spark.read.parquet(str(tmp_path / "t"))
    docs = landed.select(F.col("order_id").alias("doc_id"), "text", F.lit("2001-01-01").cast("date").alias("order_date"), F.lit("").alias("source_code"))
    rows = extract_assignments(docs)
    assert "BroadcastHashJoin" not in plan(rows) and rows.count() == 150

    store = Store(spark, str(tmp_path / "store"))
    orders = landed.select(F.col("order_id").alias("id"), F.lit("new").alias("status"))
    store.overwrite("orders", orders)
    store.put("orders", orders.withColumn("status", F.lit("extracted")))
    stored = store.read("orders")
    assert "BroadcastHashJoin" not in plan(stored) and stored.filter("status = 'extracted'").count() == 50
    assert "BroadcastHashJoin" not in plan(not_stored(orders, stored, ["id"]))


def test_orders_whose_file_repeats_are_told_from_the_first(spark):
    """A file that is stored, one that several orders share, one of its own, and none."""
    at = F.lit("2024-01-01").cast("timestamp")
    given = [("a", "h1"), ("b", "h2"), ("c", "h2"), ("d", "h3"), ("e", None)]
    orders = spark.createDataFrame([(i, "s") for i, _ in given], "id string, source_id string").select(
        "*", F.lit("new").alias("status"), F.lit("https://host/a.pdf").alias("file_url"), F.lit(None).cast("string").alias("source_url"),
        F.lit(None).cast("string").alias("order_number"), F.lit("2001-01-01").cast("date").alias("order_date"), at.alias("created_at"), F.lit(None).cast("string").alias("file_hash"))
    texts = spark.createDataFrame([(i, TEXT, h, 1, "pypdf", 1.0) for i, h in given if i != "e"],
                                  "order_id string, text string, file_hash string, page_count int, ocr_method string, ocr_confidence double")
    stored = spark.createDataFrame([("x", "h1"), ("y", "h1"), ("d", "h3")], "id string, file_hash string")
    sources, hosts = spark.createDataFrame([("s", "s")], "id string, code string"), spark.createDataFrame([("host",)], "host string")
    done = process_orders(orders, texts, sources, hosts, None, None, at, stored_orders=stored)
    got = {r.id: (r.skipped, r.stored_as, r.records) for r in done.results.collect()}
    assert got == {"a": (True, "x", 0), "b": (False, None, 3), "c": (True, None, 0), "d": (False, "d", 3), "e": (False, None, 0)}


def test_documents_are_dealt_once_for_extraction(spark):
    """Rows of a document stay together from its lines to their numbers, in each layout."""
    free = "О подтверждении спортивных разрядов. Подтвердить:\n" + "\n".join(f"Петров Иван Иванович, 0{i}.02.1980 г.р., КМС по виду спорта Бокс." for i in (1, 2, 3))
    section = "Приказ о присвоении спортивных разрядов\nБокс\n1 Иванов Иван Иванович 01.02.1980 прочее 10.02.2001\nШахматы\n2 Иванов Пётр Иванович 02.02.1980 прочее 10.02.2001"
    docs = spark.createDataFrame([("t", TEXT), ("f", free), ("s", section), ("n", "Без строк")], "doc_id string, text string").select(
        "*", F.lit("2001-01-01").cast("date").alias("order_date"), F.lit("").alias("source_code"))
    registry = spark.createDataFrame([("Бокс", "1", 1), ("Шахматы", "2", 2)], "name string, sport_id string, ord int")
    rows = extract_assignments(docs, registry)
    # The layouts come together as numbered rows, which are not dealt out again.
    assert plan(rows).index("Union") < plan(rows).index("Exchange")
    got = sorted((r.doc_id, r.row_no, r.layout, r.sport, r.assignment_type, r.action) for r in rows.collect())
    assert got == [("f", i, "free", "Бокс", "sport_rank", "confirmation") for i in (1, 2, 3)] + [
        ("s", 1, "section", "Бокс", "sport_rank", "assignment"), ("s", 2, "section", "Шахматы", "sport_rank", "assignment")] + [
        ("t", i, "table", "Бокс", "judge_category", "assignment") for i in (1, 2, 3)]
