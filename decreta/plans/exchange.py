"""Exchange export: one nested JSON document per order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decreta.functions.names import split_person_name
from decreta.operators.relational import where_all, within_dates
from decreta.session import broadcast_checked

def export_item(fio: str = "fio") -> Column:
    name = split_person_name(F.col(fio))
    return F.struct(
        name["last_name"].alias("lastName"), name["first_name"].alias("firstName"),
        name["middle_name"].alias("middleName"),
        F.date_format("birth_date", "yyyy-MM-dd").alias("birthDate"),
        F.col("sport").alias("sport"), F.col("rank_category").alias("rank"),
    )


def fold_items(assignments: DataFrame) -> DataFrame:
    """Rows of each order folded into an array in row order, in one pass.

    An order's rows come out of one document cell, which bounds the array.
    """
    folded = assignments.groupBy("order_id").agg(
        F.array_sort(F.collect_list(F.struct("created_at", "row_no", "id", export_item().alias("item")))).alias("_all"),
        F.bool_or(F.col("action") == "assignment").alias("assignment"),
    )
    return folded.select("order_id", F.transform("_all", lambda x: x["item"]).alias("items"), "assignment")


def exchange(orders: DataFrame, assignments: DataFrame, sources: DataFrame, status: str = "approved",
             source_code: str | None = None, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """One export document per order in a status; an order without rows has no items."""
    src = sources.select(F.col("id").alias("source_id"), F.col("code").alias("source_code"), "inn")
    picked = where_all(
        orders.filter(F.col("status") == status).join(broadcast_checked(src), "source_id"),
        F.col("source_code") == source_code if source_code else None,
        within_dates("order_date", date_from, date_to),
    ).select("id", "order_number", "order_date", "inn", "signed_by")
    wanted = assignments.join(picked.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    joined = picked.join(fold_items(wanted).withColumnRenamed("order_id", "id"), "id", "left")
    empty = F.array().cast(
        "array<struct<lastName:string,firstName:string,middleName:string,birthDate:string,sport:string,rank:string>>")
    return joined.select(
        "id", F.col("order_number").alias("order"), F.date_format("order_date", "yyyy-MM-dd").alias("issueDate"),
        F.col("inn").alias("issuedBy"), F.col("signed_by").alias("signedBy"),
        F.coalesce("assignment", F.lit(False)).alias("assignment"), F.lit(None).cast("string").alias("file"),
        F.coalesce("items", empty).alias("items"),
    )


def to_json_rows(df: DataFrame, out: str = "json") -> DataFrame:
    """Each row as one flat JSON text; nulls are written."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(out))


def write_exchange(documents: DataFrame, path: str) -> None:
    """JSON lines, one export document per line."""
    documents.drop("id").write.option("ignoreNullFields", "false").mode("overwrite").json(path)
