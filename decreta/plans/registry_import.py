"""Import of a sports registry version."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.records import build_code
from decreta.functions.text import sport_search_key, strip
from decreta.operators.mutations import natural_id, scd2_import, upsert
from decreta.operators.ordering import forward_fill, keep_first


class Registry(NamedTuple):
    sports: DataFrame
    names: DataFrame
    disciplines: DataFrame
    stats: DataFrame


def sheet_sports(sheets: DataFrame) -> DataFrame:
    """Sport rows of the exported sheets: a whole number, a name, then the code cells."""
    section = F.create_map(*[F.lit(x) for pair in K.REGISTRY_SHEETS.items() for x in pair])
    is_sport = strip(F.col("c1")).rlike("^[0-9]+$") & F.col("c2").isNotNull()
    cells = F.array(*[f"c{i}" for i in range(3, 10)])
    base = strip(F.col("c3")).try_cast("double").try_cast("int")
    return sheets.withColumns({
        "section": F.try_element_at(section, F.col("sheet")), "is_sport": F.coalesce(is_sport, F.lit(False)),
        "name": F.when(is_sport, strip(F.col("c2"))), "code_full": F.when(is_sport, build_code(cells)),
        "code_base": F.when(is_sport, F.coalesce(base, F.lit(0))),
    }).filter(F.col("section").isNotNull())


def explode_disciplines(sheets: DataFrame) -> DataFrame:
    """Discipline rows, each under the sport row above it (or on the same row)."""
    marked = sheet_sports(sheets)
    sport = F.when(F.col("is_sport"), F.struct("code_base", "section", "name"))
    filled = forward_fill(marked, ["sheet"], "row_no", sport, "sport")
    return filled.filter(
        F.col("sport").isNotNull() & (F.coalesce(strip(F.col("c10")), F.lit("")) != "")
    ).select("sheet", "row_no", F.col("sport.code_base").alias("code_base"), F.col("sport.section").alias("section"),
             F.col("sport.name").alias("sport_name"), strip(F.col("c10")).alias("discipline"))


def import_registry(sheets: DataFrame, sports: DataFrame, names: DataFrame, disciplines: DataFrame,
                    version_label: str, source_hash: str, effective: Column) -> Registry:
    """New snapshots of the registry tables after importing one version.

    Sports are upserted by code and section; names keep a validity history; names and
    disciplines are distinct, so importing the same version twice changes nothing.
    """
    stamp = effective.cast("timestamp")
    incoming = sheet_sports(sheets).filter("is_sport").select(
        natural_id("code_base", "section").alias("id"), "code_base", "code_full", "section",
        F.col("name").alias("current_name"), F.lit(True).alias("active"),
        stamp.alias("created_at"), stamp.alias("updated_at"), "row_no",
    )
    new_sports = upsert(sports, incoming, ["code_base", "section"], ["code_full", "current_name", "updated_at"],
                        [F.col("row_no").desc()])
    one_name = keep_first(incoming, ["id"], [F.col("row_no").desc()]).select(
        F.col("id").alias("sport_id"), F.col("current_name").alias("name"))
    history = scd2_import(names.select("sport_id", "name", "valid_from", "valid_to"), one_name,
                          "sport_id", "name", effective)
    new_names = history.select(
        natural_id("sport_id", "name", "valid_from").alias("id"), "sport_id", "name",
        sport_search_key(F.col("name")).alias("name_normalized"), F.col("valid_to").isNull().alias("is_primary"),
        "valid_from", "valid_to", F.lit(source_hash).alias("source_version_id"), stamp.alias("created_at"),
    )
    found = explode_disciplines(sheets).select(
        natural_id("code_base", "section").alias("sport_id"), F.col("discipline").alias("name")).distinct()
    fresh = found.join(disciplines.select("sport_id", "name"), ["sport_id", "name"], "left_anti")
    new_disciplines = disciplines.unionByName(fresh.select(
        natural_id("sport_id", "name").alias("id"), "sport_id", "name", F.lit(None).cast("string").alias("code_full"),
        F.lit(True).alias("active"), stamp.alias("created_at"),
    ))
    stored = sports.select("code_base", "section", F.col("current_name").alias("_old"))
    compared = incoming.join(stored, ["code_base", "section"], "left")
    stats = compared.agg(
        F.lit(version_label).alias("version_label"), F.lit(source_hash).alias("source_hash"),
        F.count(F.lit(1)).alias("sports_total"), F.count_if(F.col("_old").isNull()).alias("sports_new"),
        F.count_if(F.col("_old") != F.col("current_name")).alias("sports_updated"),
    )
    return Registry(new_sports, new_names, new_disciplines, stats)


def section_statistics(sports: DataFrame, disciplines: DataFrame) -> DataFrame:
    """Sports and disciplines per section."""
    per_sport = disciplines.groupBy("sport_id").agg(F.count(F.lit(1)).alias("_d"))
    return sports.join(per_sport, sports["id"] == per_sport["sport_id"], "left").groupBy("section").agg(
        F.count(F.lit(1)).alias("sports"), F.coalesce(F.sum("_d"), F.lit(0)).alias("disciplines"))


def sports_by_section(sports: DataFrame, section: int) -> DataFrame:
    return sports.filter(F.col("section") == section)
