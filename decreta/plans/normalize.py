"""Normalisation of stored rows: sports against the registry, ranks to stored names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.ranks import canonical_rank
from decreta.functions.text import strip
from decreta.operators.relational import join_known
from decreta.operators.matching import match_names
from decreta.session import broadcast_checked, staged


def normalize_sports(rows: DataFrame, registry: DataFrame, aliases: DataFrame,
                     threshold: float = K.REVIEW_MATCH, scorer: str = "trigram",
                     sports: DataFrame | None = None) -> DataFrame:
    """Canonical sport of each row, with method, confidence and alternatives.

    Names are matched once each and joined back, so the cost of matching follows the
    number of distinct spellings, not of rows. A row without a sport is left alone. Where
    the caller knows the sports (``name``, with all those of the rows), ``rows`` is read once.
    """
    names = rows.select(F.col("sport").alias("name")) if sports is None else sports
    found = staged(match_names(names, registry, aliases, threshold, scorer), "matches").select(
        F.col("input_name").alias("_name"), F.col("canonical_name").alias("_canonical"),
        F.col("sport_id").alias("_sport_id"), F.col("method").alias("match_method"),
        F.col("confidence").alias("match_confidence"), F.col("alternatives").alias("match_alternatives"),
    )
    # Few names stand in very many rows: dealt by name, one task would get them all.
    joined = join_known(rows.withColumn("_name", strip(F.col("sport"))), broadcast_checked(found), "_name")
    changed = F.col("_canonical").isNotNull() & (F.col("_canonical") != F.col("sport"))
    return joined.withColumns({
        "sport_original": F.when(changed, F.coalesce("sport_original", "sport")).otherwise(F.col("sport_original")),
        "sport": F.coalesce("_canonical", "sport"),
        "sport_id": F.coalesce("_sport_id", "sport_id") if "sport_id" in rows.columns else F.col("_sport_id"),
    }).drop("_name", "_canonical", "_sport_id")


def normalize_ranks(rows: DataFrame) -> DataFrame:
    """Stored rank names; the text as extracted is kept in ``rank_category_original``."""
    raw = F.col("rank_category")
    name = canonical_rank(raw)
    changed = (F.coalesce(raw, F.lit("")) != "") & (name != "") & (name != F.lower(strip(raw)))
    original = F.col("rank_category_original") if "rank_category_original" in rows.columns else F.lit(None).cast("string")
    return rows.withColumns({
        "rank_category_original": F.when(changed, F.coalesce(original, raw)).otherwise(original),
        "rank_category": F.when(changed, name).otherwise(raw),
    })


def rank_attributes(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """Category and sort order of a row's rank; null for ranks outside the table."""
    dim = ranks.select(F.col("name").alias("rank_category"), F.col("category").alias("rank_group"), "rank_order")
    return rows.join(broadcast_checked(dim), "rank_category", "left")


def dictionary_codes(rows: DataFrame, dictionary: DataFrame, name: str, on: str) -> DataFrame:
    """Code and basis of a position or title named in ``name``, as in force on day ``on``.

    Null for names outside the dictionary, before it took effect or after it ended; case
    and white space around the name do not count.
    """
    dim = dictionary.select(
        F.lower(strip(F.col("name"))).alias("_entry"), F.col("code").alias("dictionary_code"),
        F.col("source_doc").alias("dictionary_basis"), F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to"))
    day = F.col(on)
    in_force = (F.lower(strip(F.col(name))) == F.col("_entry")) & (day >= F.col("_from")) & (
        F.col("_to").isNull() | (day < F.col("_to")))
    return rows.join(broadcast_checked(dim), in_force, "left").drop("_entry", "_from", "_to")
