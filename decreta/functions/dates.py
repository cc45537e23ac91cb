"""Date expressions on dirty text. Nothing here raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from decreta.functions.text import strip

_DMY = r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$"


def to_dmy(c: Column) -> Column:
    """``DD.MM.YYYY`` text as a date, null unless it names a real day."""
    return F.when(c.rlike(_DMY), F.try_to_date(c, "d.M.yyyy"))


def is_valid_day(day: Column) -> Column:
    """A day between 1930 and 2030, given as a date."""
    return F.coalesce(F.year(day).between(1930, 2030), F.lit(False))


def is_valid_date(c: Column) -> Column:
    """Text that names a real day between 1930 and 2030."""
    return is_valid_day(to_dmy(c))


def age_in_years(birth: Column, on: Column) -> Column:
    return F.datediff(on, birth) / F.lit(365.25)


def is_plausible_birth(birth_raw: Column, order_date: Column) -> Column:
    """Valid birth date whose holder was 5 to 100 years old on the order date.

    An order without a date checks validity only.
    """
    return is_plausible_day(to_dmy(birth_raw), order_date)


def is_plausible_day(birth: Column, order_date: Column) -> Column:
    """The same for a birth date that is parsed already."""
    age = age_in_years(birth, order_date)
    return is_valid_day(birth) & F.coalesce(age.between(5, 100), F.lit(True))


def birth_year_suspicious(birth: Column, order_date: Column) -> Column:
    """Alternative rule: born less than five calendar years before the order."""
    return F.coalesce(F.year(birth) > F.year(order_date) - 5, F.lit(False))


def normalize_date_text(c: Column) -> Column:
    """Date text as ``DD.MM.YYYY``: trailing year mark dropped, either order accepted."""
    text = strip(c)
    bare = F.when(text.endswith("г."), strip(F.left(text, F.length(text) - 2))).otherwise(text)
    dotted = F.translate(bare, "-/", "..")
    return (
        F.when(dotted.rlike(r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$"), dotted)
        .when(
            dotted.rlike(r"^[0-9]{4}\.[0-9]{2}\.[0-9]{2}$"),
            F.concat_ws(".", F.substring(dotted, 9, 2), F.substring(dotted, 6, 2),
                        F.substring(dotted, 1, 4)),
        )
    )


def parse_dmy(c: Column) -> Column:
    """Date at the start of the text, as a date."""
    return to_dmy(F.nullif(F.regexp_extract(c, r"^([0-9]{2}\.[0-9]{2}\.[0-9]{4})", 1), F.lit("")))


def iso_date_text(c: Column) -> Column:
    """Export form of a stored date text: ``DD.MM.YYYY`` rewritten, ISO left alone."""
    parts = F.split(c, r"\.")
    return F.when(
        F.size(parts) == 3, F.concat_ws("-", F.get(parts, F.lit(2)), F.get(parts, F.lit(1)),
                                        F.get(parts, F.lit(0)))
    ).otherwise(c)
