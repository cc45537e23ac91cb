"""Names to registry entries: exact, alias and key lookups, then fuzzy matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.similarity import CONTAINMENT, LENGTH_WEIGHT, trigram_score, trigrams
from decreta.functions.text import match_key, strip
from decreta.operators.name_index import indexed_top
from decreta.operators.ordering import keep_first, top_per_key
from decreta.session import broadcast_checked, staged

# Registry names that are scored inside one row; more of them are indexed.
INLINE_REGISTRY = 500
# What the bonuses can add to the trigram similarity of two names.
_MAX_BONUS = CONTAINMENT + LENGTH_WEIGHT
_TOP = 5

_NO_ALTERNATIVES = "array<struct<name:string,score:double>>"


def builtin_aliases(spark) -> DataFrame:
    """Known spellings and renamings."""
    return spark.createDataFrame(
        [(a, c, i) for i, (a, c) in enumerate(K.SPORT_ALIASES)], "alias string, canonical string, ord int"
    )


def add_aliases(aliases: DataFrame, extra: DataFrame) -> DataFrame:
    """User aliases override equal ones; the others go to the end of the list."""
    new = extra.withColumn("_user", F.lit(0)).unionByName(aliases.withColumn("_user", F.lit(1)))
    return keep_first(new, ["alias"], [F.col("_user"), F.col("ord")]).drop("_user")


def _by_name(registry: DataFrame) -> DataFrame:
    return keep_first(registry, ["name"], [F.col("ord").desc()])


def prepare_registry(registry: DataFrame, aliases: DataFrame) -> DataFrame:
    """Registry and aliases as one small table, written once and read by every lookup.

    ``kind`` is ``written`` (name or alias as spelled), ``keyed`` (comparison key) or
    ``choice`` (what a misspelled name may resemble). Of equal lookups a registry name
    outranks an alias; of equal names the later registry entry counts.
    """
    by_name = _by_name(registry).select("name", "sport_id", "ord")
    ids = by_name.select(F.col("name").alias("canonical"), "sport_id", F.lit(True).alias("_known"))
    named = aliases.select("alias", "canonical", "ord").join(broadcast_checked(ids), "canonical", "left")
    first = keep_first(registry, ["name"], [F.col("ord")])

    def rows(df: DataFrame, kind: str, key: Column, canonical: str, conf: float, method: str,
             pri: int, order: Column) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), key.alias("lookup"), F.col(canonical).alias("canonical_name"),
            F.col("sport_id").cast("string").alias("sport_id"), F.lit(conf).alias("confidence"),
            F.lit(method).alias("method"),
            F.struct(F.lit(pri).alias("pri"), order.cast("bigint").alias("pos")).alias("ord"),
        )

    name, alias, pos = F.col("name"), F.col("alias"), F.col("ord")
    # A registry name that is also spelled as an alias resembles its alias target.
    as_choice = first.select("name", "ord").join(
        named.select(F.col("alias").alias("name"), F.col("canonical").alias("_to")), "name", "left"
    ).select("name", "ord", F.coalesce("_to", "name").alias("canonical")).join(
        broadcast_checked(ids), "canonical", "left")
    parts = [
        rows(by_name, "written", name, "name", 1.0, "exact", 1, pos),
        rows(named, "written", alias, "canonical", 0.98, "alias", 2, pos),
        rows(by_name, "keyed", match_key(name), "name", 0.95, "case_norm", 1, -pos),
        rows(named, "keyed", match_key(alias), "canonical", 0.95, "alias", 2, pos),
        rows(as_choice, "choice", name, "canonical", 0.0, "fuzzy", 1, pos),
        rows(named.filter("_known"), "choice", alias, "canonical", 0.0, "fuzzy", 2, pos),
    ]
    all_rows = reduce(DataFrame.unionByName, parts)
    return staged(keep_first(all_rows, ["kind", "lookup"], [F.col("ord")]), "registry")


def exact_cascade(names: DataFrame, prepared: DataFrame) -> DataFrame:
    """Look up distinct ``name`` values; unmatched ones come back with null results.

    The four stages (name, alias, key, key of an alias) are two equi-joins, as each
    lookup already holds its stages in priority order.
    """
    results = ["canonical_name", "sport_id", "confidence", "method"]

    def lookup(kind: str, tag: str) -> DataFrame:
        table = prepared.filter(F.col("kind") == kind)
        return broadcast_checked(table.select("lookup", F.struct(*results).alias(tag)))

    w, k = lookup("written", "_w"), lookup("keyed", "_k").withColumnRenamed("lookup", "_key")
    joined = (
        names.withColumn("_key", match_key(F.col("name")))
        .join(w, F.col("name") == F.col("lookup"), "left")
        .join(k, "_key", "left")
    )
    hit = F.coalesce("_w", "_k")
    return joined.select(*names.columns, *[hit[c].alias(c) for c in results])


def find_by_key(registry: DataFrame, name: str) -> DataFrame:
    """Registry entry whose comparison key equals the name's."""
    return _by_name(registry).filter(match_key(F.col("name")) == match_key(F.lit(name)))


def candidates(prepared: DataFrame) -> DataFrame:
    """Everything a name may resemble: registry names, then aliases of registry names."""
    return prepared.filter(F.col("kind") == "choice").select(
        F.col("lookup").alias("choice"), F.col("canonical_name").alias("canonical"), "sport_id", "ord"
    )


def _inline_top(names: DataFrame, choices: DataFrame, k: int, needed: Column | None = None,
                at_least: float | None = None) -> DataFrame:
    """Best ``k`` choices per name, scored inside the row (where ``needed``).

    The registry, whose size was checked, is one array computed by a scalar subquery:
    no pair ever becomes a row and the names are not shuffled. With ``at_least``, only
    choices whose trigram count is close enough to reach that score are scored.
    """
    table = choices.select("ord", "choice", "canonical", "sport_id", trigrams(F.col("choice")).alias("tri"))
    table = table.withColumn("n", F.size("tri"))
    registry = table.agg(F.array_sort(F.collect_list(F.struct(*table.columns))).alias("all")).scalar()

    def scored(c: Column) -> Column:
        score = trigram_score(F.col("name"), c["choice"], F.col("_tri"), c["tri"])
        return F.struct((-score).alias("neg"), c["ord"].alias("ord"), c["choice"].alias("choice"),
                        c["canonical"].alias("canonical"), c["sport_id"].alias("sport_id"))

    pool = F.col("_all")
    if at_least is not None:
        t = max(at_least - _MAX_BONUS, 0.01)
        n = F.col("_n")
        pool = F.filter(pool, lambda c: (c["n"] >= n * t - 1e-9) & (n >= c["n"] * t - 1e-9))
    top = F.slice(F.array_sort(F.transform(pool, scored)), 1, k)
    ranked = names.withColumn("_tri", trigrams(F.col("name"))).withColumns(
        {"_n": F.size("_tri"), "_all": registry}
    ).withColumn("_top", F.when(F.lit(True) if needed is None else needed, top))
    return ranked.drop("_tri", "_n", "_all")


def rank_candidates(names: DataFrame, choices: DataFrame, k: int = _TOP, inline_limit: int = INLINE_REGISTRY) -> DataFrame:
    """The ``k`` most similar choices of each name as rows, ties in registry order."""
    shown = F.transform("_top", lambda x, i: F.struct(
        x["choice"].alias("choice"), x["canonical"].alias("canonical"), (i + 1).alias("rank"),
        (-x["neg"]).alias("score")))
    ranked = _inline_top(names, choices, k) if _fits_inline(choices, inline_limit) else indexed_top(names, choices, k)
    return ranked.select("name", F.explode(shown).alias("c")).select("name", "c.*")


def _joined_top(names: DataFrame, choices: DataFrame, k: int, threshold: float) -> DataFrame:
    """Best ``k`` choices per name among those that can reach ``threshold``.

    Prefix-filtered trigram join: with all trigrams put in one global order, rarest
    first, two names whose similarity reaches ``t`` must share one of their first
    ``n - ceil(t n) + 1`` trigrams. As the bonuses add at most 0.25, every pair that can
    reach ``threshold`` is found; frequent trigrams fall outside the prefixes, so no
    posting list grows with the commonest syllable.
    """
    t = max(threshold - _MAX_BONUS, 0.01)
    frequency = choices.select(F.explode(trigrams(F.col("choice"))).alias("tri")).groupBy("tri").agg(
        F.count(F.lit(1)).alias("df")
    )

    def prefixed(df: DataFrame, name: str, tag: str) -> DataFrame:
        tri = df.select(F.col(name).alias(tag), F.explode(trigrams(F.col(name))).alias("tri"))
        seen = tri.join(broadcast_checked(frequency), "tri", "left").withColumn(
            "df", F.coalesce("df", F.lit(0))
        )
        ordered = seen.groupBy(tag).agg(F.array_sort(F.collect_list(F.struct("df", "tri"))).alias("o"))
        n = F.size("o")
        length = n - F.ceil(n * t - 1e-9) + 1
        return ordered.select(tag, n.alias(tag + "_n"), F.explode(
            F.transform(F.slice("o", F.lit(1), length.cast("int")), lambda x: x["tri"])
        ).alias("tri"))

    left, right = prefixed(names, "name", "q"), prefixed(choices, "choice", "c")
    near = (F.col("q_n") >= F.col("c_n") * t - 1e-9) & (F.col("c_n") >= F.col("q_n") * t - 1e-9)
    pairs = left.join(right, "tri").filter(near).select("q", "c").distinct()
    full = pairs.join(choices.withColumnRenamed("choice", "c"), "c")
    score = trigram_score(F.col("q"), F.col("c"), trigrams(F.col("q")), trigrams(F.col("c")))
    best = top_per_key(full.withColumn("score", score), ["q"],
                       [F.col("score").desc(), F.col("ord")], k)
    tops = best.groupBy(F.col("q").alias("name")).agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("neg"), "ord", F.col("c").alias("choice"), "canonical", "sport_id"
    ))).alias("_top"))
    return names.join(tops, "name", "left")


def spread_names(names: DataFrame) -> DataFrame:
    """Distinct names over all shuffle partitions.

    Scoring costs time, not bytes, so the few bytes of distinct names must not be
    merged into one task.
    """
    n = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return names.distinct().repartition(n, "name")


def _fits_inline(choices: DataFrame, limit: int) -> bool:
    return choices.limit(limit + 1).count() <= limit


def _verdict(threshold: float) -> dict[str, Column]:
    """Result columns of a ranked name."""
    best = F.get("_top", F.lit(0))
    confidence = F.coalesce(F.round(-best["neg"], 3), F.lit(0.0))
    found = confidence >= threshold
    return {
        "canonical_name": F.when(found, best["canonical"]),
        "sport_id": F.when(found, best["sport_id"]),
        "confidence": confidence,
        "method": F.when(found, "fuzzy").otherwise("not_found"),
        "alternatives": F.coalesce(
            F.transform(F.slice("_top", 2, 3), lambda x: F.struct(
                x["choice"].alias("name"), F.round(-x["neg"], 3).alias("score"))),
            F.array().cast(_NO_ALTERNATIVES),
        ),
    }


def fuzzy_match(names: DataFrame, choices: DataFrame, threshold: float = K.REVIEW_MATCH,
                scorer: str = "trigram", inline_limit: int = INLINE_REGISTRY, matches_only: bool = False) -> DataFrame:
    """Match distinct ``name`` values to the most similar choice.

    Alternatives and the confidence of unmatched names are complete at every registry
    size and with either scorer; ``inline_limit`` only chooses the plan: a small registry
    is scored inside the row, a larger one through an index that scores few pairs. With
    ``matches_only`` names are joined by trigram instead: every match at or above
    ``threshold`` is found, alternatives are those that could reach it, and a name
    without any gets confidence 0.
    """
    names = spread_names(names)
    if scorer == "token_sort" or (not matches_only and not _fits_inline(choices, inline_limit)):
        ranked = names.join(indexed_top(names, choices, _TOP, scorer), "name", "left")
    elif matches_only:
        ranked = _joined_top(names, choices, _TOP, threshold)
    else:
        ranked = _inline_top(names, choices, _TOP)
    return ranked.select(*names.columns, *[c.alias(n) for n, c in _verdict(threshold).items()])


def match_names(names: DataFrame, registry: DataFrame, aliases: DataFrame,
                threshold: float = K.REVIEW_MATCH, scorer: str = "trigram",
                inline_limit: int = INLINE_REGISTRY, complete: bool = True) -> DataFrame:
    """Full cascade over the distinct values of column ``name``.

    Result: ``input_name, canonical_name, sport_id, confidence, method, alternatives``.
    Every match at or above ``threshold`` is found. Without ``complete``, choices that
    cannot reach it are not scored, so alternatives and the confidence of unmatched
    names leave them out.
    """
    prepared = prepare_registry(registry, aliases)
    choices = candidates(prepared)
    given = spread_names(names.select(strip(F.col("name")).alias("name")).filter(F.col("name") != ""))
    looked_up = exact_cascade(given, prepared)
    hit = F.col("method").isNotNull()
    if scorer == "trigram" and _fits_inline(choices, inline_limit):
        # One pass: the fuzzy stage runs inside the row, for unmatched names only.
        ranked = _inline_top(looked_up, choices, _TOP, ~hit, None if complete else threshold)
        out = ranked.select("name", *[
            (F.when(hit, F.col(n)).otherwise(c) if n in looked_up.columns else c).alias(n)
            for n, c in _verdict(threshold).items()])
    else:
        looked_up = staged(looked_up, "looked-up")
        none = F.array().cast(_NO_ALTERNATIVES).alias("alternatives")
        rest = looked_up.filter(~hit).select("name")
        out = looked_up.filter(hit).select("*", none).unionByName(
            fuzzy_match(rest, choices, threshold, scorer, inline_limit, matches_only=not complete))
    return out.withColumnRenamed("name", "input_name")


def search_registry(registry: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """Registry names most similar to a query text."""
    q = F.lit(query)
    names = keep_first(registry, ["name"], [F.col("ord")])
    score = trigram_score(q, F.col("name"), trigrams(q), trigrams(F.col("name")))
    return names.select("name", "ord", score.alias("_s")).orderBy(
        F.col("_s").desc(), F.col("ord")
    ).limit(limit).select("name", F.round("_s", 3).alias("score"))


def coverage_report(matches: DataFrame, auto: float = K.AUTO_MATCH,
                    review: float = K.REVIEW_MATCH) -> DataFrame:
    """How many names matched, were matched surely, need review, or were not found."""
    found = F.col("method") != "not_found"
    c = F.col("confidence")
    return matches.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(found).alias("matched"),
        F.count_if(found & (c >= auto)).alias("auto_matched"),
        F.count_if(found & (c >= review) & (c < auto)).alias("review_needed"),
        F.count_if(~found).alias("not_found"),
    )
