"""Text expressions: cleaning, keys, ordered classification, readability."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from decreta import constants as K

# White space as the source documents define it (Unicode, plus the C0 separators).
_WS = r"[\s\x1c-\x1f]"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often it is used.

    Column expressions are trees: naming a costly input thirty times in a chain of
    conditions would compute it thirty times.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def has_words(c: Column, choices: Sequence[str]) -> Column:
    """Whether the text contains all words of one of the choices (separated by spaces)."""
    every = lambda words: reduce(lambda a, b: a & b, [c.contains(w) for w in words.split()])
    return reduce(lambda a, b: a | b, [every(words) for words in choices])


def has_letters(line: Column, sets: Sequence[str]) -> Column:
    """Whether the line has, in either case, all letters of one of the sets: searches of
    bytes, which spare nearly all lines a pattern that folds case at every character."""
    either = lambda x: line.contains(x) if x == x.upper() else line.contains(x) | line.contains(x.upper())
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [either(x) for x in letters]) for letters in sets])


def strip(c: Column) -> Column:
    """Drop white space at both ends."""
    return F.btrim(c, F.lit(K.WHITESPACE))


def collapse(c: Column) -> Column:
    """Every run of white space becomes one space. Runs that are one already are skipped."""
    return F.regexp_replace(c, rf"(?U)[\s\x1c-\x1f&&[^ ]]{_WS}*| {_WS}+", " ")


def substitute(c: Column, *pairs: tuple[str, str]) -> Column:
    """Each text of a pair replaced by the other, found as bytes: where it is rare, that is
    many times cheaper than ``translate``, which looks up every character."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def clean_text(c: Column) -> Column:
    """Collapse white space inside lines; drop byte-order marks and zero-width spaces.

    The pattern skips runs that are one plain space already, which is nearly all of
    them, so ordinary text is scanned without being rebuilt.
    """
    ws = r"[\s\x1c-\x1f&&[^\n]]"
    one_line = F.regexp_replace(c, rf"(?U)[\s\x1c-\x1f&&[^\n ]]{ws}*| {ws}+", " ")
    return substitute(one_line, ("\ufeff", ""), ("\u200b", ""))


def classify_first(c: Column, rules: Sequence[tuple[str, str]], default: str | None) -> Column:
    """Label of the first rule, in list order, whose pattern occurs in ``c``."""
    out = None
    for pattern, label in rules:
        # A pattern without operators is a plain substring, found without a matcher.
        hit = c.contains(pattern) if re.fullmatch(r"[\w -]+", pattern) else c.rlike(pattern)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def header_text(c: Column, chars: int | None = None) -> Column:
    """Lower-cased text, or its first ``chars`` characters."""
    return F.lower(c if chars is None else F.substring(c, 1, chars))


def detect_action(c: Column, chars: int | None = None) -> Column:
    return bind(header_text(c, chars), lambda head: classify_first(head, K.ACTION_RULES, "assignment"))


def detect_assignment_type(c: Column, chars: int | None = None) -> Column:
    """Document type from keywords of the text (its first ``chars``), in fixed priority."""
    return bind(header_text(c, chars), _type_of_header)


def detect_kind(c: Column) -> Column:
    """Struct of the document's ``type`` and ``action``, for which it is lower-cased once."""
    return bind(header_text(c), lambda head: F.struct(
        _type_of_header(head).alias("type"), classify_first(head, K.ACTION_RULES, "assignment").alias("action")))


def _type_of_header(head: Column) -> Column:
    has = head.contains
    return (
        F.when(has("почетн") | has("почётн"), "honorary_title")
        .when(has("заслуженн") & (has("мастер") | has("тренер")), "honorary_title")
        .when(has("спортивный судья") | has("судей") | has("судьи"), "judge_category")
        .when(has("специалист"), "specialist_category")
        .when(has("тренер") | has("зтр"), "coach_category")
        .otherwise("sport_rank")
    )


def fio_search_key(c: Column) -> Column:
    """Upper-case Cyrillic letters and spaces of a person name."""
    return F.upper(F.regexp_replace(c, "[^А-ЯЁа-яё ]", ""))


def sport_search_key(c: Column) -> Column:
    """Stored search key of a sport name."""
    kept = F.regexp_replace(
        F.regexp_replace(c, r"(?U)\s+", " "), r"[^А-ЯЁа-яёA-Za-z0-9 \-]", ""
    )
    return F.upper(F.trim(kept))


def match_key(c: Column) -> Column:
    """Comparison key: upper case, ё as е, no punctuation except the hyphen."""
    upper = F.translate(F.upper(strip(c)), "Ё", "Е")
    kept = F.regexp_replace(upper, r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f\-]", "")
    return F.coalesce(strip(collapse(kept)), F.lit(""))


def readable_chars(c: Column) -> Column:
    """How many characters are letters, digits, spaces or plain punctuation.

    Deleting a fixed set of characters is a table lookup each, half the cost of a
    character-class pattern.
    """
    rest = F.translate(c, K.READABLE, "")
    return F.coalesce(F.length(c) - F.length(rest), F.lit(0))


def readable_ratio(c: Column) -> Column:
    """Readable share; zero for texts under ten characters."""
    return readability(c)["ratio"]


def readability(c: Column) -> Column:
    """Struct of the readable count and the readable share, counted once."""
    size = F.length(c)
    return bind(readable_chars(c), lambda n: F.struct(
        n.alias("readable"), F.when(size >= 10, n / size).otherwise(F.lit(0.0)).alias("ratio")))


def text_pages(c: Column) -> Column:
    """Pages of a document: the text between registration footers, blank pages dropped."""
    # A split compiles its pattern for every text, so only texts with a footer are split.
    pages = F.when(c.contains(K.PAGE_FOOTER_START), F.split(c, K.PAGE_FOOTER_BLOCK, -1)).when(c.isNotNull(), F.array(c))
    return F.filter(F.transform(pages, strip), lambda p: p != "")


def text_lines(c: Column) -> Column:
    """All lines of a text, stripped; blank ones stay so positions keep their meaning."""
    return F.transform(F.split(c, "\n", -1), strip)


def render_template(template: str, values: dict[str, Column], blanks: dict[str, str]) -> Column:
    """Fill ``{name}`` placeholders from columns; blank values take their stand-in text."""
    names = sorted(values, key=template.find)
    pieces: list[Column] = []
    rest = template
    for name in (n for n in names if "{" + n + "}" in template):
        before, rest = rest.split("{" + name + "}", 1)
        value = F.coalesce(F.nullif(values[name], F.lit("")), F.lit(blanks.get(name, "")))
        pieces += [F.lit(before), value]
    pieces.append(F.lit(rest))
    return F.concat(*pieces)
