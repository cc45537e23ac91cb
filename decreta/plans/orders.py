"""Order processing: pending orders to stored assignment rows, statuses and log."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.dates import parse_dmy
from decreta.functions.text import fio_search_key
from decreta.operators.mutations import natural_id, replace_rows, update_orders
from decreta.operators.ordering import keep_first
from decreta.operators.relational import join_known, url_policy
from decreta.plans.extract import extract_assignments, extract_with_sports
from decreta.plans.normalize import normalize_ranks, normalize_sports
from decreta.plans.steps import StepLog
from decreta.session import broadcast_checked, shuffled


class Processed(NamedTuple):
    rows: DataFrame      # assignment rows of the orders that succeeded
    updates: DataFrame   # id, status and metadata of every order handled
    log: DataFrame       # one entry per order and step
    results: DataFrame   # one row per order: status, counts, error
    steps: DataFrame     # one row per step of the run: rows counted, time taken


def work_queue(orders: DataFrame, limit: int | None = None) -> DataFrame:
    """Orders waiting to be processed, oldest first."""
    waiting = orders.filter(F.col("status").isin("new", "downloaded")).orderBy("created_at", "id")
    return waiting.limit(limit) if limit else waiting


def process_orders(orders: DataFrame, texts: DataFrame, sources: DataFrame, allowed_hosts: DataFrame,
                   registry: DataFrame | None, aliases: DataFrame | None, as_of: Column,
                   primary: tuple[DataFrame, DataFrame, DataFrame] | None = None, limit: int | None = None,
                   force: bool = False, stored_orders: DataFrame | None = None) -> Processed:
    """Process the waiting orders in one plan.

    ``texts`` has ``order_id, text, file_hash, page_count, ocr_method, ocr_confidence``.
    ``primary`` is what ``parse_json_response`` made of model responses (key ``doc_id``)
    and, third, their ``answered_keys``; orders without a readable response fall back to
    the rules, and an empty answer is an answer. ``stored_orders`` are those whose files
    count as known, by default ``orders``. A failed order becomes
    an update and a log entry, never a failed job. ``force`` repeats work whose file is
    already stored.

    The steps run over all orders at once, so the time of a step is the run's and is the
    same for every order that went through it. Spark writes extracted and normalized rows
    in one pass, whose time counts as extraction.
    """
    steps = StepLog()
    codes = sources.select(F.col("id").alias("source_id"), F.col("code").alias("source_code"))
    # The order of the queue only matters where it is cut.
    waiting = work_queue(orders, limit) if limit else orders.filter(F.col("status").isin("new", "downloaded"))
    queue = waiting.join(broadcast_checked(codes), "source_id", "left")
    url = F.coalesce(F.nullif("file_url", F.lit("")), F.nullif("source_url", F.lit("")))
    checked = url_policy(queue.withColumn("_url", url), "_url", allowed_hosts)
    landed = texts.select(
        F.col("order_id").alias("id"), F.length("text").alias("text_length"), F.col("file_hash").alias("_hash"),
        F.col("page_count").alias("_pages"), F.col("ocr_method").alias("_method"),
        F.col("ocr_confidence").alias("_conf"),
    )
    stored = (orders if stored_orders is None else stored_orders).filter(F.col("file_hash").isNotNull()).select(
        F.col("file_hash").alias("_hash"), F.col("id").alias("stored_as"))
    stored = keep_first(stored, ["_hash"], [F.col("stored_as")])
    work = checked.join(shuffled(landed), "id", "left")
    first_of_hash = work.filter(F.col("_hash").isNotNull()).groupBy("_hash").agg(
        F.min(F.struct("created_at", "id"))["id"].alias("_first"), F.count(F.lit(1)).alias("_copies"))
    # Only hashes that are stored or repeated tell anything: few, though most rows may have one of them.
    known = first_of_hash.join(shuffled(stored), "_hash", "left").filter("stored_as IS NOT NULL OR _copies > 1").drop("_copies")
    work = join_known(work, known, "_hash")
    repeated = F.lit(not force) & (
        (F.col("stored_as").isNotNull() & (F.col("stored_as") != F.col("id")))
        | (F.col("_first").isNotNull() & (F.col("_first") != F.col("id")))
    )
    error = (
        F.when(F.col("_url").isNull(), "Нет URL для скачивания")
        .when(~F.col("url_allowed"), F.concat(F.lit("URL заблокирован (SSRF): "), F.col("_url")))
        .when(F.col("text_length").isNull(), "Текст документа не получен")
    )
    work = steps.write(
        work.withColumns({"_error": error, "_repeated": F.coalesce(repeated, F.lit(False))}), "download",
        failed=F.col("_error").isNotNull(), repeated=F.col("_error").isNull() & F.col("_repeated"))

    ready = work.filter(F.col("_error").isNull() & ~F.col("_repeated"))
    # The texts themselves join last, for the orders that will be read.
    docs = ready.select(F.col("id").alias("doc_id"), "order_date", "source_code").join(
        shuffled(texts.select(F.col("order_id").alias("doc_id"), "text")), "doc_id")
    if primary is not None:
        rows, _, answered = primary
        by_rules, sports = _rows_by_rules(docs.join(shuffled(answered), "doc_id", "left_anti"), registry, aliases)
        by_model = rows.join(shuffled(docs.select("doc_id", "order_date")), "doc_id").select(
            *[F.col(c) for c in by_rules.columns if c in rows.columns or c == "order_date"],
            F.col("item_no").alias("row_no"), F.lit("primary").alias("layout"),
            F.lit(None).cast("double").alias("confidence"), F.lit("model").alias("llm_model"),
        )
        extracted = by_rules.unionByName(by_model.select(by_rules.columns))
        if sports is not None:
            sports = sports.unionByName(by_model.select(F.col("sport").alias("name")))
    else:
        extracted, sports = _rows_by_rules(docs, registry, aliases)
    named = normalize_ranks(extracted).withColumn("sport_id", F.lit(None).cast("string"))
    if registry is not None:
        named = normalize_sports(named, registry, aliases, sports=sports)
    else:
        named = named.withColumn("match_method", F.lit(None).cast("string"))
    is_matched = F.col("match_method").isNotNull() & (F.col("match_method") != "not_found")
    rows = steps.write(named, "extract", matched=is_matched, unmatched=F.col("match_method") == "not_found")

    counts = rows.groupBy(F.col("doc_id").alias("id")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(is_matched).alias("matched"),
        F.count_if(F.col("match_method") == "not_found").alias("unmatched"),
    )
    done = work.join(shuffled(counts), "id", "left").na.fill(0, ["records", "matched", "unmatched"])
    failed_extract = "Извлечение не удалось (LLM и rule_extractor)"
    done = done.withColumn("error", F.coalesce(
        "_error", F.when(~F.col("_repeated") & (F.col("records") == 0), failed_extract)))
    results = steps.write(done.select(
        "id", "source_id", "source_code", "order_number",
        F.when(F.col("error").isNotNull(), "failed").otherwise("extracted").alias("status"),
        F.col("_repeated").alias("skipped"), "stored_as", "records", "matched", "unmatched",
        "text_length", "error", F.col("_url").alias("url"),
        F.col("_hash").alias("file_hash"), F.col("_pages").alias("page_count"),
        F.col("_method").alias("ocr_method"), F.col("_conf").alias("ocr_confidence"),
    ), "save", failed=F.col("error").isNotNull(), skipped=F.col("skipped"))
    updates = results.filter(~F.col("skipped")).select(
        "id", "status", "file_hash", "ocr_method", "ocr_confidence",
        F.col("page_count").cast("int").alias("page_count"), F.col("error").alias("error_message"),
    )
    return Processed(_to_table(rows, as_of), updates, _log(results, steps, as_of), results, steps.frame(orders.sparkSession))


def _rows_by_rules(docs: DataFrame, registry: DataFrame | None,
                   aliases: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Extracted rows and the sports they can have."""
    rows, sports = extract_with_sports(docs, registry, aliases)
    return rows.withColumn("submission_number", F.lit(None).cast("string")), sports


def _to_table(rows: DataFrame, as_of: Column) -> DataFrame:
    """Extracted rows in the stored shape."""
    return rows.select(
        natural_id("doc_id", "row_no").alias("id"), F.col("doc_id").alias("order_id"),
        F.col("row_no").cast("int").alias("row_no"), "fio", fio_search_key(F.col("fio")).alias("fio_normalized"),
        parse_dmy(F.col("birth_date_raw")).alias("birth_date"), "birth_date_raw", "ias_id",
        "submission_number", "assignment_type", "rank_category", "rank_category_original", "sport",
        "sport_original", "sport_id", "action", "extra_fields", "llm_model", "confidence",
        as_of.alias("created_at"),
    )


def _log(results: DataFrame, steps: StepLog, as_of: Column) -> DataFrame:
    """Log entries of the batch: every step that an order reached, up to the one that failed.

    ``details`` holds what the step found, and at the step that ran jobs of its own the
    milliseconds it took for the whole batch.
    """
    error, lit = F.col("error"), F.lit
    blocked = error.startswith("Нет URL") | error.startswith("URL заблокирован")
    no_text, repeated = F.col("text_length").isNull(), F.col("skipped") & error.isNull()
    no_rows = error.isNotNull() & ~repeated

    def step(reached: Column, stage: str, failed: Column, message: Column, **details: Column) -> Column:
        failed = F.coalesce(failed, lit(False))
        pairs = [x for name, value in details.items() for x in (lit(name), value.cast("string"))]
        found = F.map_filter(F.create_map(*pairs).cast("map<string,string>"), lambda _, v: v.isNotNull())
        return F.when(F.coalesce(reached, lit(True)), F.struct(
            lit(stage).alias("stage"), F.when(failed, "error").otherwise("info").alias("level"),
            F.when(failed, error).otherwise(message).alias("message"), found.alias("details")))

    time_of = lambda stage: lit(steps.duration(stage))
    has_text = ~F.coalesce(blocked, lit(False))
    is_new = has_text & ~no_text & ~repeated
    is_read = is_new & error.isNull()
    entries = F.array_compact(F.array(
        step(lit(True), "download", blocked, F.concat(lit("Скачан: "), F.col("url")),
             url=F.col("url"), duration_ms=time_of("download")),
        step(has_text & repeated, "dedup", lit(False),
             F.concat(lit("Файл уже обработан: "), F.coalesce("stored_as", lit("")))),
        step(has_text & ~repeated, "ocr", no_text,
             F.format_string("%s стр., %s символов, метод=%s", F.col("page_count").cast("string"),
                             F.col("text_length").cast("string"), F.col("ocr_method")),
             page_count=F.col("page_count"), text_length=F.col("text_length"), method=F.col("ocr_method"),
             confidence=F.col("ocr_confidence")),
        step(is_new, "extract", no_rows, F.format_string("Извлечено %d записей", "records"),
             duration_ms=time_of("extract")),
        step(is_read, "normalize", lit(False), F.format_string("Спорт: %d норм. / %d не найд.", "matched", "unmatched"),
             matched=F.col("matched"), unmatched=F.col("unmatched")),
        step(is_read, "save", lit(False), F.format_string("Сохранено %d записей из %d", "records", "records"),
             records=F.col("records"), duration_ms=time_of("save")),
    ))
    return log_entries(results.select(
        F.col("id").alias("order_id"), "source_id", F.explode(entries).alias("_e"),
    ).select("order_id", "source_id", "_e.level", "_e.stage", "_e.message", "_e.details", as_of.alias("created_at")))


def log_entries(entries: DataFrame) -> DataFrame:
    """Entries ready to append: id from content, messages whole."""
    return entries.withColumn(
        "id", natural_id("order_id", "source_id", "stage", "message", "created_at")
    )


def processed_orders(done: Processed) -> DataFrame:
    """``order_id`` of the orders whose rows were extracted, also of those without any."""
    ok = (F.col("status") == "extracted") & ~F.col("skipped")
    return done.results.filter(ok).select(F.col("id").alias("order_id"))


def apply_processed(orders: DataFrame, assignments: DataFrame, done: Processed,
                    as_of: Column) -> tuple[DataFrame, DataFrame]:
    """New snapshots of the order and assignment tables."""
    rows = done.rows.select(assignments.columns)
    return (
        update_orders(orders, shuffled(done.updates), as_of),
        replace_rows(assignments, rows, "order_id", shuffled(processed_orders(done))),
    )


def dry_run(docs: DataFrame, registry: DataFrame | None = None, aliases: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows and per-document summary of a trial run; writes no table."""
    rows = extract_assignments(docs, registry, aliases)
    summary = docs.select("doc_id", F.length("text").alias("text_length")).join(
        rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("records"),
                                   F.round(F.avg("confidence"), 3).alias("avg_confidence")), "doc_id", "left",
    ).na.fill(0, ["records", "avg_confidence"])
    return rows, summary


def batch_summary(results: DataFrame) -> DataFrame:
    """Succeeded, failed and saved rows of a batch."""
    ok = F.col("status") == "extracted"
    saved = F.when(ok & ~F.col("skipped"), F.col("records")).otherwise(0)
    return results.agg(
        F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(saved), F.lit(0)).alias("records_saved"),
    )
