"""Person names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.text import collapse, strip


def clean_person_name(c: Column) -> Column:
    """Drop punctuation at both ends and collapse inner spaces."""
    # Trims of fixed sets instead of two patterns: the end of the text is stripped, so that
    # white space is only met behind or before the punctuation.
    marks, white = F.lit("-.,;:"), F.lit(K.WHITESPACE)
    bare = F.ltrim(F.ltrim(strip(c), marks), white)
    bare = F.rtrim(F.rtrim(bare, marks), white)
    return F.coalesce(strip(collapse(bare)), F.lit(""))


def unglue_words(c: Column) -> Column:
    """Split words glued by text recognition where lower case meets upper case."""
    return F.regexp_replace(c, "([а-яё])([А-ЯЁ])", "$1 $2")


def split_person_name(c: Column) -> Column:
    """Struct of last name, first name and whatever follows."""
    words = F.split(strip(collapse(c)), " ")
    word = lambda i: F.nullif(F.get(words, F.lit(i)), F.lit(""))
    rest = F.when(
        F.size(words) > 2, F.array_join(F.slice(words, F.lit(3), F.greatest(F.size(words) - 2, F.lit(1))), " ")
    )
    return F.struct(
        word(0).alias("last_name"), word(1).alias("first_name"), rest.alias("middle_name")
    )


def coach_list(c: Column) -> Column:
    """Coaches of one cell as an array; blanks dropped, single words kept as they are."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")
