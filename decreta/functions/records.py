"""Row-level scores, flags and codes of extracted records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.dates import is_plausible_day, is_valid_date, is_valid_day, normalize_date_text, to_dmy
from decreta.functions.names import clean_person_name
from decreta.functions.text import collapse, strip


def row_confidence(fio: Column, birth_raw: Column, sport: Column, rank: Column,
                   person_id: Column, birth: Column | None = None) -> Column:
    """Share of expected fields present; a missing optional id halves its weight.

    ``birth`` is the parsed birth date where the caller has it.
    """
    present = [
        F.size(F.split(strip(collapse(fio)), " ")) >= 2,
        is_valid_date(birth_raw) if birth is None else is_valid_day(birth),
        F.length(sport) > 2,
        F.length(rank) > 3,
        person_id != 0,
    ]
    score = sum((F.coalesce(p, F.lit(False)).cast("double") for p in present), F.lit(0.0))
    total = F.when(F.coalesce(person_id != 0, F.lit(False)), 5.0).otherwise(4.5)
    return F.round(F.least(score / total, F.lit(1.0)), 2)


def flag_rows(df: DataFrame, order_date: str = "order_date", birth: Column | None = None) -> DataFrame:
    """Review marks in ``extra_fields`` and the confidence cap for impossible dates.

    Reads ``birth_date_raw``, ``confidence`` and ``extra_fields``. ``birth`` is the parsed
    birth date where the caller has it.
    """
    raw = F.col("birth_date_raw")
    has_birth = F.coalesce(raw != "", F.lit(False))
    born = to_dmy(raw) if birth is None else birth
    invalid = has_birth & ~is_valid_day(born)
    odd = has_birth & ~is_plausible_day(born, F.col(order_date))
    none = F.create_map().cast("map<string,string>")
    mark = lambda cond, key: F.when(cond, F.create_map(F.lit(key), F.lit("true"))).otherwise(none)
    extra = F.coalesce(F.col("extra_fields"), none)
    review = (F.col("confidence") < 0.5) & ~F.map_contains_key(extra, "needs_review")
    others = F.map_filter(extra, lambda key, _: key != "birth_date_suspicious")
    return df.withColumns({
        "extra_fields": F.when(odd | review, F.map_concat(
            F.when(odd, others).otherwise(extra), mark(odd, "birth_date_suspicious"), mark(review, "needs_review"),
        )).otherwise(extra),
        "confidence": F.when(invalid, F.least(F.col("confidence"), F.lit(0.6))).otherwise(F.col("confidence")),
    })


def build_code(cells: Column) -> Column:
    """Registry code of a row's cells: up to the first empty one, whole numbers bare."""
    trimmed = F.transform(cells, strip)
    first_empty = F.array_position(
        F.transform(trimmed, lambda x: F.coalesce(x, F.lit("")) == ""), F.lit(True)
    )
    kept = F.when(first_empty > 0, F.slice(trimmed, F.lit(1), (first_empty - 1).cast("int"))).otherwise(trimmed)

    def bare(x: Column) -> Column:
        number = x.try_cast("double")
        whole = x.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$") & (number == F.floor(number))
        return F.when(whole, number.try_cast("bigint").cast("string")).otherwise(x)

    return F.array_join(F.transform(kept, bare), "-")


def coerce_assignment(df: DataFrame, item: str = "item") -> DataFrame:
    """Typed assignment fields of an untyped item struct, with a reject reason.

    ``item`` has the all-text fields of ``schemas.RESPONSE_ITEM``. Rows whose
    ``reject_reason`` is set miss a required field and must not be stored.
    """
    g = lambda name: F.col(f"{item}.{name}")
    fio = clean_person_name(g("fio"))
    rank = F.coalesce(strip(g("rank_category")), F.lit(""))
    sport = F.nullif(g("sport"), F.lit(""))
    original = F.nullif(g("sport_original"), F.lit(""))
    extra = F.coalesce(g("extra_fields"), F.create_map().cast("map<string,string>"))
    return df.withColumns({
        "fio": fio,
        "birth_date_raw": normalize_date_text(g("birth_date")),
        "ias_id": F.coalesce(strip(g("ias_id")).try_cast("int"),
                             F.when(g("ias_id").rlike(r"^\s*-?[0-9]+\.[0-9]+\s*$"),
                                    g("ias_id").try_cast("double").try_cast("int"))),
        "submission_number": F.nullif(strip(g("submission_number")), F.lit("")),
        "assignment_type": F.when(g("assignment_type").isin(K.ASSIGNMENT_TYPES), g("assignment_type"))
                            .otherwise("sport_rank"),
        "rank_category": rank,
        "sport": strip(sport),
        "sport_original": F.when(original.eqNullSafe(strip(sport)), None).otherwise(original),
        "action": F.when(g("action").isin(K.ACTIONS), g("action")).otherwise("assignment"),
        "extra_fields": F.map_filter(
            extra, lambda _, v: v.isNotNull() & (v != "") & (v != "[]")
        ),
        "reject_reason": F.when(F.col(item).isNull(), "not an object")
                          .when(fio == "", "empty name")
                          .when(rank == "", "empty rank"),
    })
