"""Scalar functions against fixed cases and small Python oracles."""

import hashlib
import re
from datetime import date
from urllib.parse import urljoin

from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions import dates as D
from decreta.functions import names as N
from decreta.functions import pages as P
from decreta.functions import ranks as R
from decreta.functions import records as Rec
from decreta.functions import similarity as S
from decreta.functions import text as X


def test_dates(evaluate):
    given = ["15.03.1990", "01.01.2020", "32.01.2020", "not-a-date", "", "01.01.1900", "31.02.2001", "1.3.1990", None]
    assert evaluate(D.is_valid_date, given) == [True, True, False, False, False, False, False, True, False]
    order = F.lit(date(2026, 2, 17))
    births = ["10.02.2025", "10.02.1990", "01.01.1931", "x"]
    assert evaluate(lambda c: D.is_plausible_birth(c, order), births) == [False, True, True, False]
    assert evaluate(lambda c: D.is_plausible_birth(c, F.lit(None).cast("date")), ["10.02.2025"]) == [True]


def test_date_texts(evaluate):
    given = ["01.02.1990 г.", "01-02-1990", "01/02/1990", "1990-02-01", " 1990.02.01 ", "junk", "", None]
    want = ["01.02.1990"] * 5 + [None] * 3
    assert evaluate(D.normalize_date_text, given) == want
    assert evaluate(D.parse_dmy, ["01.02.1990 x", "31.02.1990", None]) == [date(1990, 2, 1), None, None]
    assert evaluate(D.iso_date_text, ["01.02.1990", "1990-02-01"]) == ["1990-02-01", "1990-02-01"]


RANKS = {
    "Спортивный судья третьей\nкатегории": "спортивный судья третьей категории",
    "Спортивный судья всероссийской категории": "спортивный судья всероссийской категории",
    "юный спортивный судья": "юный спортивный судья", "КМС": "кандидат в мастера спорта",
    "1 разряд": "первый спортивный разряд", "I разряд": "первый спортивный разряд",
    "II разряд": "второй спортивный разряд", "III разряд": "третий спортивный разряд",
    "II спортивный разряд": "второй спортивный разряд", "1 юношеский разряд": "первый юношеский спортивный разряд",
    "II юношеский разряд": "второй юношеский спортивный разряд", "III юнош. разряд": "третий юношеский спортивный разряд",
    "третий юношеский спортивный разряд": "третий юношеский спортивный разряд", "мастер спорта": "мастер спорта россии",
    "МС": "мастер спорта россии", "МСМК": "мастер спорта россии международного класса",
    "ЗМС": "заслуженный мастер спорта россии", "гроссмейстер России": "гроссмейстер россии", "ГМ": "гроссмейстер россии",
    "заслуженный тренер России": "заслуженный тренер россии", "ЗТР": "заслуженный тренер россии",
    "Специалист первой квалификационной\nкатегории": "специалист первой квалификационной категории",
    "просто текст": "просто текст",
}


def test_ranks(evaluate):
    assert evaluate(R.normalize_rank, list(RANKS)) == list(RANKS.values())
    stored = [n for n in RANKS.values() if n != "просто текст"]
    assert evaluate(R.normalize_rank, stored) == stored
    assert evaluate(R.rank_in_text, ["по виду КМС", "ничего"]) == ["кандидат в мастера спорта", None]


def test_canonical_ranks(evaluate):
    given = ["КМС", " Мастер  спорта ", "III разряд", "2 юношеский", "первый разряд", "Заслуж. тренер", "почётный мастер", "что-то", "", None]
    want = ["кандидат в мастера спорта", "мастер спорта россии", "третий спортивный разряд", "второй юношеский спортивный разряд",
            "первый спортивный разряд", "заслуженный тренер россии", "почетный мастер спорта россии", "", "", ""]
    assert evaluate(R.canonical_rank, given) == want


def test_document_type_and_action(evaluate):
    heads = ["О присвоении почётного спортивного звания заслуженный мастер спорта России",
             "О присвоении квалификационных категорий спортивных судей", "О присвоении спортивных разрядов по виду спорта",
             " " * 3000 + "тренер"]
    opening = lambda c: X.detect_assignment_type(c, 3000)
    assert evaluate(opening, heads) == ["honorary_title", "judge_category", "sport_rank", "sport_rank"]
    assert evaluate(X.detect_assignment_type, heads) == ["honorary_title", "judge_category", "sport_rank", "coach_category"]
    acts = ["ПРИКАЗЫВАЮ: 1. Присвоить категории", "Подтвердить категорию", "Восстановить звание", "Отказать; присвоить", "нет"]
    assert evaluate(X.detect_action, acts) == ["assignment", "confirmation", "restoration", "assignment", "assignment"]


def test_names(evaluate):
    assert evaluate(N.unglue_words, ["ШолинМаксимАндреевич"]) == ["Шолин Максим Андреевич"]
    assert evaluate(N.clean_person_name, ["-Суликова  Анна .", " ;", None]) == ["Суликова Анна", "", ""]
    got = evaluate(N.split_person_name, ["Иванов Иван Иванович", "Петрова  Мария", "Ким Чен Ир оглы", " ", "Один"])
    assert [tuple(r) for r in got] == [("Иванов", "Иван", "Иванович"), ("Петрова", "Мария", None),
                                       ("Ким", "Чен", "Ир оглы"), (None, None, None), ("Один", None, None)]
    assert evaluate(N.coach_list, ["Иванов И.И., Петров П.П.", "Самоподготовка", ","]) == [
        ["Иванов И.И.", "Петров П.П."], ["Самоподготовка"], []]


def test_keys(evaluate):
    assert evaluate(X.fio_search_key, ["Ёлкин-Иванов И. 5"]) == ["ЁЛКИНИВАНОВ И "]
    assert evaluate(X.match_key, [" Кёрлинг,  (муж.) а-б ", None]) == ["КЕРЛИНГ МУЖ А-Б", ""]
    assert evaluate(X.sport_search_key, [" Бокс \n (жен.)  а-б"]) == ["БОКС ЖЕН А-Б"]


def test_clean_text_matches_a_python_rule(evaluate):
    given = ["a \t b  c\nd  e \n f", "﻿x​y", "один два", " a", "a\x1c\x1db"]
    want = [re.sub(r"[^\S\n]+", " ", t).replace("﻿", "").replace("​", "") for t in given]
    assert evaluate(X.clean_text, given) == want


def test_readability(evaluate):
    given = ["Привет, мир 12!", "☃☃☃☃☃☃☃☃☃☃", "short", None]
    pattern = r"[А-ЯЁа-яёA-Za-z0-9\s.,;:\-()\"'«»№/]"
    counts = [len(re.findall(pattern, t)) if t else 0 for t in given]
    assert evaluate(X.readable_chars, given) == counts
    assert evaluate(X.readable_ratio, given) == [counts[0] / 15, 0.0, 0.0, 0.0]


def test_row_confidence(spark):
    row = spark.range(1).select(
        Rec.row_confidence(F.lit("Тестов Тест"), F.lit("01.01.1990"), F.lit("Бокс"), F.lit("судья"), F.lit(None).cast("int")),
        Rec.row_confidence(F.lit("Тестов Тест"), F.lit("01.01.1990"), F.lit("Бокс"), F.lit("судья"), F.lit(5)),
        Rec.row_confidence(F.lit("Тестов"), F.lit("x"), F.lit(None).cast("string"), F.lit(""), F.lit(None).cast("int")),
    ).first()
    assert list(row) == [0.89, 1.0, 0.0]


def test_registry_code(evaluate):
    given = [["166.0", "0", " 5 ", "Я", None, "9", ""], ["", "1"], ["1.5", "x"]]
    assert evaluate(Rec.build_code, given, "array<string>") == ["166-0-5-Я", "", "1.5-x"]


def _fingerprint(html):
    c = re.sub(r"<script[^>]*>.*?</script>", "", html, flags=re.S | re.I)
    c = re.sub(r"<style[^>]*>.*?</style>", "", c, flags=re.S | re.I)
    c = re.sub(r"<!--.*?-->", "", c, flags=re.S)
    c = re.sub(r"\s+", " ", c).strip()
    c = re.sub(r"""(csrf|nonce|token|session|timestamp)=["'][^"']*["']""", "", c, flags=re.I)
    return hashlib.sha256(c.encode()).hexdigest()


def test_page_fingerprint(evaluate):
    same = "<html><body>content</body></html>"
    given = [same, same.replace("</body>", "<SCRIPT>var x=1;</script></body>"), "<html><body>new</body></html>",
             "<p nonce='1'>a  b</p><!-- x\n -->"]
    got = evaluate(P.page_fingerprint, given)
    assert got == [_fingerprint(h) for h in given]
    assert got[0] == got[1] != got[2]
    assert evaluate(P.is_challenge_page, ["<b>Just a Moment", "ok"]) == [True, False]


def test_resolve_url_is_urljoin(spark):
    bases = ["https://h.org/a/b/c.html?x=1#f", "http://h.org", "https://h.org/dir/"]
    hrefs = ["/p/q.pdf", "q.pdf", "../up.pdf", "../../../far", "./x", "?page=2", "#top", "//other.org/y", "", "https://abs.org/z",
             "javascript:alert(1)", "/a/./b/../c", "a//b"]
    rows = [(b, h) for b in bases for h in hrefs]
    got = spark.createDataFrame(rows, "b string, h string").select(
        "b", "h", P.resolve_url(F.col("b"), F.col("h")).alias("u")).collect()
    assert [(r.b, r.h, r.u) for r in got] == [(b, h, urljoin(b, h)) for b, h in rows]


def _trigrams(s):
    p = f"  {s.lower().strip()} "
    return {p[i:i + 3] for i in range(len(p) - 2)}


def test_trigrams_and_score(spark, evaluate):
    names = ["Бокс", "Автомобильный спорт", "а", "aaaa", ""]
    assert [set(x) for x in evaluate(S.trigrams, names)] == [_trigrams(n) for n in names]

    def score(a, b):
        ta, tb = _trigrams(a), _trigrams(b)
        tri = len(ta & tb) / len(ta | tb)
        inside = 0.15 if a.lower() in b.lower() or b.lower() in a.lower() else 0.0
        return min(1.0, tri + inside + min(len(a), len(b)) / max(len(a), len(b), 1) * 0.1)

    pairs = [(a, b) for a in names[:4] for b in names[:4]]
    got = spark.createDataFrame(pairs, "a string, b string").select(S.trigram_score(
        F.col("a"), F.col("b"), S.trigrams(F.col("a")), S.trigrams(F.col("b")))).collect()
    assert [r[0] for r in got] == [score(a, b) for a, b in pairs]


def test_token_sort_score_is_lcs(spark):
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            prev = 0
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    def score(a, b):
        a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
        return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0

    names = ["спорт водный", "водный спорт", "Бокс", "бокса", "", "abcabcab"]
    pairs = [(a, b) for a in names for b in names]
    got = spark.createDataFrame(pairs, "a string, b string").select(S.token_sort_score(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [score(a, b) for a, b in pairs]


def test_rules_in_text_share_lower_case_patterns():
    assert all(p == p.lower() or "\\" not in p or p.lower().count("\\") == p.count("\\") for p, _ in K.RANK_RULES)
