"""Order texts in three layouts, derived from the given orders and line items.

Every order becomes a document whose rows are its line items: a table page, free text
or sections, by order key. ``EXPECTED_SQL`` says from the line items alone which rows
extraction must return.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decreta.queries.model import table
from decreta.session import staged

SURNAMES = ["Иванов", "Петров", "Сидоров", "Козлов", "Морозов", "Волков", "Лебедев"]
FIRST = ["Иван", "Пётр", "Алексей", "Дмитрий", "Сергей"]
PATRONYMIC = ["Иванович", "Петрович", "Андреевич"]
SPORTS = ["Бокс", "Дзюдо", "Автомобильный спорт", "Нарды", "Плавание", "Спортивная акробатика", "Шахматы"]
JUDGES = ["первой", "второй", "третьей"]
RANKS = [
    ("первый спортивный разряд", "первый спортивный разряд"), ("II спортивный разряд", "второй спортивный разряд"),
    ("КМС", "кандидат в мастера спорта"), ("третий юношеский спортивный разряд", "третий юношеский спортивный разряд"),
]


def _arr(values):
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _at(values, index):
    return f"element_at({_arr(values)}, CAST(({index}) % {len(values)} + 1 AS INT))"


_FIELDS = {
    "fio": f"concat_ws(' ', {_at(SURNAMES, 'r.s')}, {_at(FIRST, 'r.p')}, {_at(PATRONYMIC, 'r.p + r.s')})",
    "birth": "date_format(date_add(DATE '1965-01-01', CAST((r.p * 37 + r.s) % 11000 AS INT)), 'dd.MM.yyyy')",
    "sport": f"CASE WHEN r.p % 5 = 0 THEN lower({_at(SPORTS, 'r.p')}) ELSE {_at(SPORTS, 'r.p')} END",
    "judge": f"concat('Спортивный судья ', {_at(JUDGES, 'r.s')}, '\\nкатегории')",
    "rank": _at([r[0] for r in RANKS], "r.s"),
}


def order_rows(spark: SparkSession, sf_dir: str, of: DataFrame | None = None, **more: str) -> DataFrame:
    """Line items of each order (of those in ``of``) as one ordered array, orders dealt evenly
    over the tasks: what is made of them costs time, not bytes, so few bytes must not be merged.
    ``more`` are further fields, made of ``r`` (``n, p, s``) row by row and not inside the array."""
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition(tasks, "l_orderkey")
    if of is not None:
        items = items.join(of, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    made = items.selectExpr("l_orderkey", "named_struct('n', l_linenumber, 'p', l_partkey, 's', l_suppkey) AS r").selectExpr(
        "l_orderkey", "named_struct('n', r.n, 'p', r.p, 's', r.s" + "".join(f", '{k}', {v}" for k, v in more.items()) + ") AS r")
    return made.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("r")).alias("rows"))


def order_texts(spark: SparkSession, sf_dir: str, where: str | None = None, landed: dict[str, str] | None = None) -> DataFrame:
    """Documents: ``doc_id, order_date, source_code, text`` and the columns ``landed``, made of
    these once. A job that reads the texts of some orders says ``where``, so that no others are made."""
    orders = table(spark, sf_dir, "orders").filter(where or "true").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    f = _FIELDS
    named = _at(SPORTS, "r.p")
    person = f"concat_ws(' ', {f['fio']}, {f['birth']}"
    # What a line says after its number, by the layout of its document.
    body = f"""CASE l_orderkey % 3 WHEN 0 THEN {person}, {f['sport']}, '10.02.2001')
      WHEN 1 THEN concat_ws(', ', {f['fio']}, concat({f['birth']}, ' г.р.'), concat({f['rank']}, ' по виду спорта ', {named}, '.'))
      ELSE {person}, 'прочее', '10.02.2001') END"""
    head = f"CASE l_orderkey % 3 WHEN 0 THEN {f['judge']} WHEN 2 THEN {f['sport']} END"
    docs = order_rows(spark, sf_dir, orders if where else None, body=body, head=head).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    line = lambda text: f"array_join(transform(rows, (r, i) -> {text}), '\\n')"
    row = "concat(CAST(i + 1 AS STRING), ' ', r.body)"
    page = "concat('О присвоении квалификационных категорий спортивных судей\\n№ ФИО Дата рождения Вид спорта Категория Дата представления\\n1 2 3 4 5 6\\n', {rows}, '\\n', {cats}, '\\nДокумент зарегистрирован № 1\\nСтраница 1 из 1. Создана\\n')"
    section = f"concat(r.head, '\\n', {row})"
    text = f"""CASE o_orderkey % 3
      WHEN 0 THEN {page.format(rows=line(row), cats=line('r.head'))}
      WHEN 1 THEN concat('О подтверждении спортивных разрядов. Подтвердить:\\n', {line('r.body')})
      ELSE concat('Приказ о присвоении спортивных разрядов по видам спорта\\n', {line(section)}) END"""
    texts = docs.selectExpr("o_orderkey AS doc_id", "order_date",
                            "CASE WHEN o_orderkey % 3 = 0 THEN 'moskva_tstisk' ELSE '' END AS source_code", f"{text} AS text")
    # Landed as a table, like texts that another job recognised, in even files.
    return staged(texts.selectExpr("*", *[f"{v} AS {k}" for k, v in (landed or {}).items()]), "order-texts")


def sport_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, f"sport-{i}", i) for i, s in enumerate(SPORTS)], "name string, sport_id string, ord int")


def _duck(values, index):
    return "([" + ", ".join(f"'{v}'" for v in values) + f"])[1 + CAST({index} AS BIGINT) % {len(values)}]"


# Rows of an order in text order; n_rows decides how short section pages are routed.
EXPECTED_SQL = f"""ln AS (
  SELECT l_orderkey AS doc_id, ROW_NUMBER() OVER w AS i, COUNT(*) OVER (PARTITION BY l_orderkey) AS n_rows,
    l_partkey AS p, l_suppkey AS s FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)),
f AS (SELECT ln.*, CAST(o_orderdate AS DATE) AS order_date,
    {_duck(SURNAMES, 's')} || ' ' || {_duck(FIRST, 'p')} || ' ' || {_duck(PATRONYMIC, 'p + s')} AS fio,
    DATE '1965-01-01' + CAST((p * 37 + s) % 11000 AS INT) AS birth, {_duck(SPORTS, 'p')} AS sport, p % 5 = 0 AS lowered,
    {_duck(JUDGES, 's')} AS judge, {_duck([r[1] for r in RANKS], 's')} AS rank,
    CASE WHEN doc_id % 3 = 0 THEN 'table' WHEN doc_id % 3 = 1 THEN 'free' WHEN n_rows = 2 THEN 'section' ELSE 'table' END AS layout
  FROM ln JOIN orders ON doc_id = o_orderkey),
expected AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY i) AS row_no FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id, fio, birth ORDER BY i) AS copy FROM f) WHERE copy = 1)"""
