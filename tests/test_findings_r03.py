"""Odd inputs that a review ran: repeated keys, shared URLs, ties, one day too many."""

from pyspark.sql import functions as F

import __spark_entry__ as entry


def test_document_files_of_null_texts_and_repeated_ids(spark, tmp_path):
    rows = [(1, "a"), (1, "b"), (2, None), (3, "x" * 5999), (4, "x" * 6000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = entry.queries()["document_files"](spark, str(tmp_path)).select("doc_id", "length").collect()
    assert sorted(map(tuple, got)) == [(1, 2), (1, 2), (3, 6000)]


def test_daily_throughput_has_no_more_than_its_days(spark):
    from decreta.plans.metrics import daily_throughput

    days = spark.range(40).select(
        F.expr("TIMESTAMP_NTZ'2001-08-02 00:00:00' - make_dt_interval(CAST(id AS INT))").alias("extracted_at"),
        F.lit(1).alias("page_count"), F.lit(0.5).alias("ocr_confidence"))
    got = [r.dt for r in daily_throughput(days, F.expr("TIMESTAMP_NTZ'2001-08-01 00:00:00'")).collect()]
    assert len(got) == 30 and str(got[0]) == "2001-08-02" and str(got[-1]) == "2001-07-04"


def test_main_document_of_pages_that_share_a_url(spark):
    from decreta.operators.links import group_attachments

    rows = [(page, "u", pos, f"{page}-{pos}") for page in (9, 2, 5) for pos in (0, 1)]
    for part in (rows, rows[::-1]):
        links = spark.createDataFrame(part, "page_id long, page_url string, pos int, url string").coalesce(1)
        got = group_attachments(links, F.col("page_id")).filter("attachment_num = 1").collect()
        assert {r.parent_url for r in got} == {"2-0"} and len(got) == 3


def _shared_urls(spark, folder):
    rows = [(i, "http://h/a" if i < 4 else f"http://h/{i}", f"<p>{i}</p>") for i in range(6)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(folder / "pages.parquet"))
    return sorted((url, k, "first" if k == 0 else "changed" if i % 3 == 0 else "unchanged") for i, url, _ in rows for k in range(4))


def test_stream_hash_changes_of_pages_that_share_a_url(spark, tmp_path):
    expected = _shared_urls(spark, tmp_path)
    assert sorted(map(tuple, entry.queries()["stream_hash_changes"](spark, str(tmp_path)).collect())) == expected


def test_stream_late_snapshots_of_pages_that_share_a_url(spark, tmp_path):
    expected = _shared_urls(spark, tmp_path)
    assert sorted(map(tuple, entry.queries()["stream_late_snapshots"](spark, str(tmp_path)).collect())) == expected


def test_golay_keys_propose_near_copies(spark, monkeypatch):
    """Without bands the copies within two bits are found all the same, and compared."""
    from corpus_pipeline import near_duplicates
    from decreta.llm import near_copies

    empty = spark.createDataFrame([], "key long, node long")
    monkeypatch.setattr(near_copies, "_bands", lambda classes: empty)
    text = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "another text"), (4, None), (5, " ")], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_duplicates(spark, docs, "").collect()) == [1, 3, 4]


def test_few_names_in_many_rows_are_broadcast(spark):
    from decreta.operators.extraction import section_rows
    from decreta.operators.matching import builtin_aliases
    from decreta.plans.normalize import normalize_sports
    from decreta.queries import corpus

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        headings = spark.sql("VALUES ('a', 'A') AS t(line, heading_sport)")
        lines = spark.createDataFrame([], "doc_id long, page_no int, line_no int, line string, parts array<string>, kind string, section_row boolean, heading_candidate boolean")
        assert "hashpartitioning(line" not in plan(section_rows(lines, headings))
        rows = spark.createDataFrame([(1, "Бокс", None)], "id int, sport string, sport_original string")
        assert "hashpartitioning(_name" not in plan(normalize_sports(rows, corpus.sport_registry(spark), builtin_aliases(spark)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rows_without_a_key_are_joined_in_one_read(spark):
    from decreta.operators.relational import join_known

    read = spark.sparkContext.accumulator(0)
    tick = F.udf(lambda key: (read.add(1), key)[1]).asNondeterministic()
    rows = spark.createDataFrame([(i, "a" if i % 2 else None, {"x": "y"}) for i in range(10)], "i int, key string, m map<string,string>")
    known = spark.createDataFrame([("a", 7)], "key string, found int")
    got = join_known(rows.withColumn("key", tick("key")), known, "key").collect()
    assert sorted((r.i, r.key, r.found, r.m["x"]) for r in got) == [(i, *(("a", 7) if i % 2 else (None, None)), "y") for i in range(10)]
    assert read.value == 10


def test_sports_of_extracted_rows_are_known_without_a_second_extraction(spark):
    from decreta.operators.matching import builtin_aliases
    from decreta.plans.extract import extract_with_sports
    from decreta.plans.normalize import normalize_sports
    from decreta.queries import corpus

    registry, aliases = corpus.sport_registry(spark), builtin_aliases(spark)
    docs = corpus.order_texts(spark, "/root/testdata/sf0.001")
    rows, sports = extract_with_sports(docs, registry, aliases)
    assert {r.sport for r in rows.select("sport").distinct().collect() if r.sport} <= {r.name for r in sports.collect()}
    read = spark.sparkContext.accumulator(0)
    tick = F.udf(lambda sport: (read.add(1), sport)[1]).asNondeterministic()
    named = spark.createDataFrame([("Бокс",), ("дзюдо",), ("Неведомое дело",), (None,)], "sport string").withColumn("sport", tick("sport"))
    given = named.sparkSession.createDataFrame([("Бокс",), ("дзюдо",), ("Неведомое дело",), ("Нарды",)], "name string")
    got = normalize_sports(named.withColumn("sport_original", F.lit(None).cast("string")), registry, aliases, sports=given).collect()
    assert sorted((r.sport or "", r.match_method or "") for r in got) == [
        ("", ""), ("Бокс", "exact"), ("Дзюдо", "case_norm"), ("Неведомое дело", "not_found")]
    assert read.value == 4


def test_texts_are_made_for_the_orders_asked_for(spark):
    from decreta.queries import corpus

    d = "/root/testdata/sf0.001"
    pending = spark.read.parquet(f"{d}/orders.parquet").filter("o_orderstatus = 'P'").selectExpr("o_orderkey AS doc_id")
    some = corpus.order_texts(spark, d, "o_orderstatus = 'P'", {"n": "length(text)"})
    whole = corpus.order_texts(spark, d).join(pending, "doc_id", "left_semi").withColumn("n", F.length("text"))
    assert sorted(some.collect()) == sorted(whole.select(some.columns).collect()) and some.count()


def test_quality_judges_few_bytes_at_a_time(spark, monkeypatch):
    """The same verdicts, but no more n-grams in memory than those of PIECE_BYTES of text."""
    import numpy as np

    from decreta.llm import quality as Q

    texts = [(f"text{i} words of a document " * 2000).encode() for i in range(60)]
    good = np.arange(60) % 2 == 0
    seen, whole = [], Q.Batch

    class Counted(whole):
        def __init__(self, batch):
            seen.append(sum(map(len, batch)))
            super().__init__(batch)

    monkeypatch.setattr(Q, "Batch", Counted)
    weights, slope, offset = Q.fit(texts, good, 0.5)
    assert max(seen) <= Q.PIECE_BYTES and sum(seen) == sum(map(len, texts))
    monkeypatch.setattr(Q, "PIECE_BYTES", 1 << 30)
    again, slope2, offset2 = Q.fit(texts, good, 0.5)
    assert (weights == again).all() and (slope, offset) == (slope2, offset2)


def test_stored_keys_are_not_gathered_in_a_map(spark):
    from decreta.operators.relational import already_stored, not_stored

    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "c")], "k int, v string")
    stored = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    old, new = already_stored(rows, stored, ["k", "v"]), not_stored(rows, stored, ["k", "v"])
    assert [tuple(r) for r in old.collect()] == [(1, "a")]
    assert sorted(r.k for r in new.collect()) == [1, 2, 3]
    for df in (old, new):
        assert "HashAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_packing_and_passages_hold_few_bytes_at_a_time(spark, monkeypatch):
    """The same pieces and texts, from stretches of no more than 1 MB."""
    import public_tokenizers
    from decreta.llm import batches, packing, substring

    docs = spark.createDataFrame([(i, f"text {i} " + f"w{i} of a document " * 5000) for i in range(24)], "doc_id long, text string").coalesce(1)
    seen, tokens = [], public_tokenizers.path("word_bpe_49k.json")

    def noted(df, fn, schema, **more):
        seen.append(more.get("limit", batches.BATCH_BYTES))
        return batches.map_batches(df, fn, schema, **more)

    def results():
        return sorted(packing.pieces_of(docs, tokens, 0, packing.CAPACITY).collect()), sorted(substring.remove_repeats(docs).collect())

    for module in (packing, substring):
        monkeypatch.setattr(module, "map_batches", noted)
    small = results()
    assert seen and max(seen) <= 1 << 20
    for module in (packing, substring):
        monkeypatch.setattr(module, "TEXT_BYTES", 1 << 30)
    assert results() == small


def test_rank_rules_search_words_before_patterns(spark):
    """Every rule's words are searched first; results are those of the patterns alone."""
    from decreta import constants as K
    from decreta.functions.ranks import _NAMED, rank_in_text
    from decreta.operators.extraction import _is_category_start

    parts = ["", "3", "2-й", "1", "III", "II", "I", "третий", "Второй", "ПЕРВЫЙ", "спортивный", "юношеский", "разряд", "(юнош", "юношеский разряд",
             "Заслуженный", "мастер", "мастер спорта", "спорта России", "международного класса", "кандидат в мастера спорта", "КМС", "МСМК",
             "ЗМС", "гм", "Гроссмейстер", "заслуж. тренер России", "ЗТР", "Почетный", "спортивный судья", "тренер России", "судья", "всероссийской",
             "первой", "второй\nкатегории", "третьей категории", "юный", "СПЕЦИАЛИСТ высшей", "квалификационной категории", "ᲃпециалист первой",
             "ГКУ", "от _", "Список лиц", "Приложение", "зарегистрирован", "Москомспорт", "прочее"]
    texts = spark.createDataFrame([(f"{a} {b} {c}".strip(),) for a in parts for b in parts for c in parts[::4]], "t string")
    t = F.col("t")
    plain = F.coalesce(*[F.when(F.lower(t).rlike("(?U)" + p.lower()), name) for p, name in K.RANK_RULES if name], F.when(
        t.rlike("(?iuU)" + next(p for p, name in K.RANK_RULES if not name)),
        F.concat(F.lit("специалист "), F.regexp_extract(t, "(?iuU)" + K.SPECIALIST_LEVEL, 1), F.lit(" квалификационной категории"))))
    start = t.rlike(K.CATEGORY_START) & ~t.rlike(K.CATEGORY_NOISE)
    wrong = texts.filter(~rank_in_text(t).eqNullSafe(plain) | ~_is_category_start(t).eqNullSafe(start))
    assert [r.t for r in wrong.collect()] == []
    assert len({r[0] for r in texts.select(plain).distinct().collect()}) == 19
    assert all(words for _, _, words in _NAMED)
