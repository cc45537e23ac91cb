"""Layouts, routing and clean-up of order texts."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from decreta.operators import documents as Doc
from decreta.operators import extraction as X
from decreta.operators.matching import builtin_aliases
from decreta.plans.extract import extract_assignments
from decreta.plans.metrics import run_metrics
from decreta.plans.orders import apply_processed, batch_summary, dry_run, process_orders

TABLE = """Приложение к приказу
№ ФИО Дата рождения Вид спорта Категория Дата представления
1 2 3 4 5 6
1 Иванов Иван Иванович 15.03.1990 Бокс 10.02.2026
2 Петрова Мария Сергеевна 22.07.1985 Бокс 10.02.2026
3 Сидоров Алексей Петрович 03.11.1992 Дзюдо 10.02.2026
Спортивный судья третьей
категории
Спортивный судья третьей
категории
Спортивный судья второй
категории
Документ зарегистрирован № С-1/26 от 10.02.2026 Тест (ГКУ)
Страница 1 из 1. Страница создана: 10.02.2026 12:00
"""
GLUED = """1 ШолинМаксимАндреевич 15.03.1978 Нарды 10.02.2026
Спортивный судья второй
категории
Документ зарегистрирован № test
Страница 1 из 1. test
"""
FREE = """Присвоить спортивные разряды:
Иванов Иван Иванович, 15.03.1990 г.р., первый спортивный разряд по боксу
Петрова Мария Сергеевна, 22.07.1985 г.р., кандидат в мастера спорта по дзюдо
Сидоров Алексей Петрович, 03.11.1992 г.р., второй спортивный разряд по плаванию"""
ONE = "Козлов Пётр Андреевич, 05.05.1995 г.р., мастер спорта по шахматам"
SECTION = """О присвоении спортивных разрядов
Автомобильный спорт
1 Иванов Иван Иванович 01.01.1990 прочее 10.02.2026
Бокс
2 Петров Пётр Петрович 02.02.1985 56789 прочее 10.02.2026
"""
TWO_PAGES = TABLE + """4 Орлов Олег Олегович 01.01.1980 Нарды 10.02.2026
Спортивный судья первой
категории
Документ зарегистрирован № 2
Страница 2 из 2."""


@pytest.fixture(scope="module")
def registry(spark):
    names = ["Бокс", "Дзюдо", "Автомобильный спорт", "Нарды", "Плавание"]
    return spark.createDataFrame([(n, f"s{i}", i) for i, n in enumerate(names)], "name string, sport_id string, ord int")


def docs(spark, texts, source=""):
    return spark.createDataFrame([(k, v, date(2026, 2, 17), source) for k, v in texts.items()],
                                 "doc_id string, text string, order_date date, source_code string")


def by_doc(rows):
    out = {}
    for r in rows.orderBy("doc_id", "row_no").collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_layouts_without_registry(spark):
    texts = {"t": TABLE, "g": GLUED, "f": FREE, "one": ONE, "empty": "", "short": "abc", "two": TWO_PAGES}
    got = by_doc(extract_assignments(docs(spark, texts)))
    assert set(got) == {"t", "g", "f", "one", "two"}
    assert [r.fio for r in got["t"]] == ["Иванов Иван Иванович", "Петрова Мария Сергеевна", "Сидоров Алексей Петрович"]
    assert [r.sport for r in got["t"]] == ["Бокс", "Бокс", "Дзюдо"]
    assert [r.rank_category for r in got["t"]] == ["спортивный судья третьей категории"] * 2 + ["спортивный судья второй категории"]
    assert got["t"][0].confidence == 0.89 and got["t"][0].layout == "table"
    assert [r.fio for r in got["g"]] == ["Шолин Максим Андреевич"]
    assert [r.rank_category for r in got["f"]] == ["первый спортивный разряд", "кандидат в мастера спорта", "второй спортивный разряд"]
    assert [r.fio for r in got["one"]] == ["Козлов Пётр Андреевич"]
    assert got["two"][3].rank_category == "спортивный судья первой категории"


def test_sections_and_context_sports(spark, registry):
    got = by_doc(extract_assignments(docs(spark, {"s": SECTION, "f": FREE}), registry, builtin_aliases(spark)))
    assert [(r.sport, r.layout, r.confidence, r.ias_id) for r in got["s"]] == [
        ("Автомобильный спорт", "section", 0.75, None), ("Бокс", "section", 0.75, 56789)]
    assert got["f"][0].sport == "Бокс"


def test_compat_routes_unhinted_tables_to_free_text(spark):
    text = {"t": TABLE}
    assert by_doc(extract_assignments(docs(spark, text), compat=True))["t"][0].layout == "free"
    hinted = by_doc(extract_assignments(docs(spark, text, "moskva_tstisk"), compat=True))
    assert hinted["t"][0].layout == "table"


def _sequential_categories(lines):
    """The block read line by line, for comparison with the window plan."""
    import re
    start = re.compile(r"судья|разряд|КМС|МС|мастер|специалист|кандидат", re.I)
    noise = re.compile(r"ГКУ|Москомспорт|___|Приложение|от\s+_|Список\s+лиц|зарегистрирован", re.I)
    stop = re.compile(r"^\d|^[Сс]портивный|^[Кк]андидат|^[Мм]астер")
    out, i = [], 0
    while i < len(lines):
        if start.search(lines[i]) and not noise.search(lines[i]):
            text = lines[i]
            if i + 1 < len(lines) and not stop.search(lines[i + 1]):
                text += " " + lines[i + 1]
                i += 1
            out.append(text)
        i += 1
    return out


def test_category_block_equals_a_sequential_reading(spark):
    pool = ["Спортивный судья третьей", "категории", "КМС", "1 разряд", "кандидат в мастера спорта", "МС и прочее", "ГКУ судья", "текст"]
    rng = random.Random(7)
    blocks = {f"d{n}": [rng.choice(pool) for _ in range(rng.randint(1, 12))] for n in range(60)}
    rows = [(d, 1, i, line, True) for d, lines in blocks.items() for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "doc_id string, page_no int, line_no int, line string, in_block boolean")
    got = {}
    for r in X.category_starts(df).filter("category is not null").orderBy("doc_id", "line_no").collect():
        got.setdefault(r.doc_id, []).append(r.category)
    assert got == {d: c for d, lines in blocks.items() if (c := _sequential_categories(lines))}


def test_post_process_order_of_steps(spark):
    rows = spark.createDataFrame([
        ("d", 1, 1, "ШолинМаксим", "01.02.1980", 0.9), ("d", 1, 2, "ШолинМаксим", "01.02.1980", 0.8),
        ("d", 1, 3, "Шолин Максим", "01.02.1980", 0.7), ("d", 1, 4, "Приказ Минспорта", "01.02.1980", 0.9),
        ("d", 1, 5, "Ан", "01.02.1980", 0.9), ("d", 1, 6, "Иванов Иван", "01.02.1901", 0.9), ("d", 1, 7, "Юный Пётр", "01.02.2024", 0.9),
    ], "doc_id string, page_no int, line_no int, fio string, birth_date_raw string, confidence double").withColumns({
        "order_date": F.lit("2026-01-01").cast("date"), "extra_fields": F.create_map(F.lit("parse_method"), F.lit("x"))})
    got = [(r.line_no, r.fio, r.confidence, "birth_date_suspicious" in r.extra_fields)
           for r in X.post_process(X.with_birth_date(rows)).orderBy("line_no").collect()]
    assert got == [(1, "Шолин Максим", 0.9, False), (3, "Шолин Максим", 0.7, False),
                   (6, "Иванов Иван", 0.6, True), (7, "Юный Пётр", 0.9, True)]


def test_chunks_keep_every_character_and_break_at_lines(spark):
    rng, size = random.Random(3), 20
    texts = ["".join(rng.choice("ab\n\n ") for _ in range(rng.randint(0, 200))) for _ in range(40)] + ["x" * 45, "", "abcdefghij", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {}
    for r in Doc.chunk_text(df, "doc_id", "text", size).orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r.doc_id, []).append(r.chunk)
    assert set(got) == {i for i, t in enumerate(texts) if t is not None}
    for i, chunks in got.items():
        assert "".join(chunks) == texts[i] and all(0 < len(c) <= size for c in chunks) or chunks == [""]
        at = 0
        for c in chunks[:-1]:
            fits = texts[i][at:at + size]
            if "\n\n" in fits:
                assert c.endswith("\n\n") and "\n\n" not in fits[len(c) - 1:]
            elif "\n" in fits:
                assert c.endswith("\n") and "\n" not in fits[len(c):]
            else:
                assert len(c) == size
            at += len(c)
    four = Doc.chunk_text(df.filter("text = 'abcdefghij'"), "doc_id", "text", 4)
    assert [r.chunk for r in four.orderBy("chunk_no").collect()] == ["abcd", "efgh", "ij"]


def test_model_responses(spark):
    good = '```json\n[{"fio": "-Иванов  Иван", "rank_category": "КМС", "birth_date": "1990-01-02", "ias_id": "12", "action": "odd", "extra_fields": {"coach_fio": ["А"], "department": ""}}, {"fio": ""}, 3]\n```'
    df = spark.createDataFrame([("a", good), ("b", "нет данных"), ("c", "[{bad]")], "doc_id string, response string")
    rows, rejects = Doc.parse_json_response(df, ["doc_id"], "response")
    r = rows.collect()
    assert len(r) == 1 and (r[0].fio, r[0].birth_date_raw, r[0].ias_id, r[0].action) == ("Иванов Иван", "02.01.1990", 12, "assignment")
    assert set(r[0].extra_fields) == {"coach_fio"}
    assert sorted((x.doc_id, x.reject_reason) for x in rejects.collect()) == [
        ("a", "empty name"), ("a", "not an object"), ("b", "no JSON array"), ("c", "no JSON array")]


def test_awards(spark):
    df = spark.createDataFrame([(1, "Иванов Пётр - орден \nСидоров - медаль")], "doc_id int, text string")
    assert [(r.name, r.award) for r in Doc.parse_awards(df, "doc_id", "text").orderBy("pos").collect()] == [
        ("Иванов Пётр", "орден"), ("Сидоров", "медаль")]


def test_process_orders_end_to_end(spark, registry):
    orders = spark.createDataFrame([
        ("o1", "S", "1", "new", "https://ok.org/a.pdf", None), ("o2", "S", "2", "new", "https://bad.org/a.pdf", None),
        ("o3", "S", "3", "downloaded", None, None), ("o4", "S", "4", "new", "https://ok.org/b.pdf", None),
        ("o5", "S", "5", "approved", "https://ok.org/c.pdf", "h5"), ("o6", "S", "6", "new", "https://ok.org/d.pdf", None),
        ("o7", "S", "7", "new", "https://ok.org/e.pdf", None),
    ], "id string, source_id string, order_number string, status string, file_url string, file_hash string").withColumns({
        "source_url": F.lit(None).cast("string"), "order_date": F.lit("2026-02-17").cast("date"), "created_at": F.current_timestamp(),
        "error_message": F.lit(None).cast("string"), "ocr_method": F.lit(None).cast("string"), "ocr_confidence": F.lit(None).cast("double"),
        "page_count": F.lit(None).cast("int"), "extracted_at": F.lit(None).cast("timestamp")})
    texts = spark.createDataFrame([("o1", TABLE, "h1"), ("o4", "nothing to see here " * 5, "h4"), ("o6", FREE, "h5"), ("o7", TABLE, "h1")],
                                  "order_id string, text string, file_hash string").withColumns({
        "page_count": F.lit(1), "ocr_method": F.lit("pypdf"), "ocr_confidence": F.lit(1.0)})
    sources = spark.createDataFrame([("S", "moskva_tstisk")], "id string, code string")
    hosts = spark.createDataFrame([("ok.org",)], "host string")
    at = F.lit("2026-03-01").cast("timestamp")
    done = process_orders(orders, texts, sources, hosts, registry, builtin_aliases(spark), at)
    got = {r.id: (r.status, r.skipped, r.records) for r in done.results.collect()}
    assert got == {"o1": ("extracted", False, 3), "o2": ("failed", False, 0), "o3": ("failed", False, 0), "o4": ("failed", False, 0),
                   "o6": ("extracted", True, 0), "o7": ("extracted", True, 0)}
    old = done.rows.limit(0)
    new_orders, new_rows = apply_processed(orders, old, done, at)
    assert {r.id: r.status for r in new_orders.collect()} == {
        "o1": "extracted", "o2": "failed", "o3": "failed", "o4": "failed", "o5": "approved", "o6": "new", "o7": "new"}
    assert new_rows.count() == 3 and new_rows.first().sport_id is not None
    assert tuple(batch_summary(done.results).first()) == (3, 3, 3)
    assert done.log.filter("level = 'error'").count() == 3
    stages = {}
    for r in done.log.collect():
        stages.setdefault(r.order_id, {})[r.stage] = r
    assert set(stages["o1"]) == {"download", "ocr", "extract", "normalize", "save"} and set(stages["o6"]) == {"download", "dedup"}
    assert set(stages["o2"]) == set(stages["o3"]) == {"download"} and stages["o4"]["extract"].level == "error"
    assert stages["o1"]["normalize"].details["matched"] == "3" and int(stages["o1"]["save"].details["duration_ms"]) >= 0
    steps = {r.stage: r for r in done.steps.collect()}
    assert steps["download"].counts == {"rows": 6, "failed": 2, "repeated": 2} and steps["extract"].counts["rows"] == 3
    assert steps["save"].counts["failed"] == 3 and steps["extract"].duration_ms > 0
    metrics = {r.order_id: r for r in run_metrics(done.log).collect()}
    assert (metrics["o1"].steps, metrics["o1"].records, metrics["o1"].matched) == (5, 3, 3) and metrics["o2"].failed_steps == 1
    rows, summary = dry_run(docs(spark, {"t": TABLE, "x": "a" * 60}))
    assert rows.count() == 3 and {r.doc_id: r.records for r in summary.collect()} == {"t": 3, "x": 0}
