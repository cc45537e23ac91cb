"""Fixed values.

Everything in this module is a value that has to be spelled exactly this way for
results to be right: enumerations, word lists, lookup tables, limits, patterns and
formats of the published orders this engine reads. There is no logic here.

Patterns are Java regular expressions. ``(?iuU)`` makes case folding and the
``\\w \\s \\d \\b`` classes Unicode-aware, which Cyrillic text needs.
"""

# --- enumerations -----------------------------------------------------------
ASSIGNMENT_TYPES = [
    "sport_rank", "judge_category", "specialist_category",
    "coach_category", "honorary_title",
]
ACTIONS = ["assignment", "confirmation", "refusal", "revocation", "restoration"]
ORDER_STATUSES = ["new", "downloaded", "extracted", "approved", "rejected", "failed"]
ORDER_TYPES = ["приказ", "распоряжение"]
RISK_CLASSES = ["green", "amber", "red"]
SOURCE_TYPES = ["pdf_portal", "json_embed", "html_table"]
LOG_LEVELS = ["info", "warn", "error"]
TEXT_METHODS = ["pypdf", "pdfminer", "tesseract", "vision"]
REGISTRY_SECTIONS = [1, 2, 3, 4]
RANK_CATEGORIES = ["звание", "разряд", "юношеский_разряд"]

# --- limits -----------------------------------------------------------------
MAX_DOCUMENT_BYTES = 50 * 1024 * 1024
MAX_DOCUMENT_PAGES = 200
MIN_READABLE_PER_PAGE = 80
MIN_READABLE_RATIO = 0.70
CHUNK_CHARS = 120_000
HEADER_CHARS = 3000
MIN_TEXT_CHARS = 50
LINK_CONTEXT_CHARS = 500
AUTO_MATCH = 0.85
REVIEW_MATCH = 0.70
SECTION_MATCH = 0.80
HEADING_MATCH = 0.85
HEADING_MAX_CHARS = 60

# Characters that count as white space when text is stripped or collapsed.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- document type and action -----------------------------------------------
ACTION_RULES = [
    ("присвоить", "assignment"),
    ("(?U)подтвердить|считать\\s+подтвердив", "confirmation"),
    ("отказать", "refusal"),
    ("лишить", "revocation"),
    ("восстановить", "restoration"),
]

# --- ranks ------------------------------------------------------------------
# Ordered: the first pattern found wins. An empty name marks the specialist rule,
# whose level is read from the text.
RANK_RULES = [
    (r"(?:заслуж\w*\s+мастер\s+спорта|ЗМС)\b", "заслуженный мастер спорта россии"),
    (r"(?:мастер\s+спорта\s+(?:России\s+)?международного\s+класса|МСМК)\b",
     "мастер спорта россии международного класса"),
    (r"(?:гроссмейстер(?:\s+России)?|ГМ|ГМР)\b", "гроссмейстер россии"),
    (r"(?:кандидат\s+в\s+мастера\s+спорта|КМС)\b", "кандидат в мастера спорта"),
    (r"(?:мастер\s+спорта(?:\s+России)?|МС)\b", "мастер спорта россии"),
    (r"(?:заслуж\w*\s+тренер\s+России|ЗТР)\b", "заслуженный тренер россии"),
    (r"почетн\w*\s+спортивн\w*\s+судь\w*\s+России", "почетный спортивный судья россии"),
    (r"почетн\w*\s+мастер\w*\s+спорта\s+России", "почетный мастер спорта россии"),
    (r"почетн\w*\s+тренер\w*\s+России", "почетный тренер россии"),
    (r"(?:третий|3|III)\s*(?:-й)?\s*(?:юношеский\s+)?(?:юношеский\s+)?(?:спортивный\s+)?разряд\s*\(?\s*юнош",
     "третий юношеский спортивный разряд"),
    (r"(?:второй|2|II)\s*(?:-й)?\s*(?:юношеский\s+)?(?:юношеский\s+)?(?:спортивный\s+)?разряд\s*\(?\s*юнош",
     "второй юношеский спортивный разряд"),
    (r"(?:первый|1|I)\s*(?:-й)?\s*(?:юношеский\s+)?(?:юношеский\s+)?(?:спортивный\s+)?разряд\s*\(?\s*юнош",
     "первый юношеский спортивный разряд"),
    (r"(?:третий|3)\s+юношеский\s+(?:спортивный\s+)?разряд", "третий юношеский спортивный разряд"),
    (r"(?:второй|2)\s+юношеский\s+(?:спортивный\s+)?разряд", "второй юношеский спортивный разряд"),
    (r"(?:первый|1)\s+юношеский\s+(?:спортивный\s+)?разряд", "первый юношеский спортивный разряд"),
    (r"\bIII\s+юнош", "третий юношеский спортивный разряд"),
    (r"\bII\s+юнош", "второй юношеский спортивный разряд"),
    (r"\bI\s+юнош", "первый юношеский спортивный разряд"),
    (r"(?:третий|3)\s*(?:-й)?\s*(?:спортивный\s+)?разряд", "третий спортивный разряд"),
    (r"(?:второй|2)\s*(?:-й)?\s*(?:спортивный\s+)?разряд", "второй спортивный разряд"),
    (r"(?:первый|1)\s*(?:-й)?\s*(?:спортивный\s+)?разряд", "первый спортивный разряд"),
    (r"\bIII\s*(?:-й)?\s*(?:спортивный\s+)?разряд", "третий спортивный разряд"),
    (r"\bII\s*(?:-й)?\s*(?:спортивный\s+)?разряд", "второй спортивный разряд"),
    (r"\bI\s*(?:-й)?\s*(?:спортивный\s+)?разряд", "первый спортивный разряд"),
    (r"спортивный\s+судья\s+всеросс\w*\s*\n?\s*категории", "спортивный судья всероссийской категории"),
    (r"спортивный\s+судья\s+первой\s*\n?\s*категории", "спортивный судья первой категории"),
    (r"спортивный\s+судья\s+второй\s*\n?\s*категории", "спортивный судья второй категории"),
    (r"спортивный\s+судья\s+третьей\s*\n?\s*категории", "спортивный судья третьей категории"),
    (r"юный\s+спортивный\s+судья", "юный спортивный судья"),
    (r"специалист\s+(?:высшей|первой|второй)\s*\n?\s*квалификационной\s*\n?\s*категории", ""),
]
# For each named rule, in order, what a lower-case text that it matches must contain: one
# of these sets of words, whole.
RANK_WORDS = [
    ("заслуж мастер", "змс"), ("международного", "мсмк"), ("гроссмейстер", "гм"), ("кандидат", "кмс"), ("мастер", "мс"),
    ("заслуж тренер", "зтр"), ("почетн судь",), ("почетн мастер",), ("почетн тренер",),
    ("третий разряд юнош", "3 разряд юнош", "iii разряд юнош"), ("второй разряд юнош", "2 разряд юнош", "ii разряд юнош"),
    ("первый разряд юнош", "1 разряд юнош", "i разряд юнош"), ("третий юношеский", "3 юношеский"), ("второй юношеский", "2 юношеский"),
    ("первый юношеский", "1 юношеский"), ("iii юнош",), ("ii юнош",), ("i юнош",), ("третий разряд", "3 разряд"),
    ("второй разряд", "2 разряд"), ("первый разряд", "1 разряд"), ("iii разряд",), ("ii разряд",), ("i разряд",),
    ("судья всеросс",), ("судья первой",), ("судья второй",), ("судья третьей",), ("юный судья",),
]
# Letters of the specialist rule, in either case; none has a third form.
SPECIALIST_LETTERS = ("цфг",)
SPECIALIST_LEVEL = r"(высшей|первой|второй)\s*квалификационной\s*категории"

# Exact spellings (lower case, ё folded to е) of the stored rank names.
RANK_ALIASES = {
    "кмс": "кандидат в мастера спорта",
    "кандидат в мастера спорта": "кандидат в мастера спорта",
    "мс": "мастер спорта россии",
    "мастер спорта": "мастер спорта россии",
    "мастер спорта россии": "мастер спорта россии",
    "мсмк": "мастер спорта россии международного класса",
    "мастер спорта международного класса": "мастер спорта россии международного класса",
    "змс": "заслуженный мастер спорта россии",
    "заслуженный мастер спорта": "заслуженный мастер спорта россии",
    "заслуженный мастер спорта россии": "заслуженный мастер спорта россии",
    "гроссмейстер россии": "гроссмейстер россии",
    "гм": "гроссмейстер россии",
    "гмр": "гроссмейстер россии",
    "зтр": "заслуженный тренер россии",
    "заслуженный тренер россии": "заслуженный тренер россии",
}
# Ordered: (stems that must all occur, stored name).
TITLE_STEMS = [
    (("кандидат", "мастер"), "кандидат в мастера спорта"),
    (("международ", "мастер"), "мастер спорта россии международного класса"),
    (("заслуж", "мастер"), "заслуженный мастер спорта россии"),
    (("мастер", "спорта"), "мастер спорта россии"),
    (("заслуж", "тренер"), "заслуженный тренер россии"),
    (("гроссмейстер",), "гроссмейстер россии"),
    (("почетн", "судь"), "почетный спортивный судья россии"),
    (("почетн", "мастер"), "почетный мастер спорта россии"),
    (("почетн", "тренер"), "почетный тренер россии"),
]
# Ordered: (digit or roman numeral, stem, adult name, youth name).
RANK_LEVELS = [
    (r"(?U)\b(3|iii)\b", "трет", "третий спортивный разряд", "третий юношеский спортивный разряд"),
    (r"(?U)\b(2|ii)\b", "втор", "второй спортивный разряд", "второй юношеский спортивный разряд"),
    (r"(?U)\b(1|i)\b", "перв", "первый спортивный разряд", "первый юношеский спортивный разряд"),
]

# --- order text layouts -----------------------------------------------------
NAME_WORDS = r"[А-ЯЁ][а-яё]+(?:\s*[А-ЯЁа-яё][а-яё]+){1,4}"
DMY = r"\d{2}\.\d{2}\.\d{4}"
# number, name, birth date, sport, submission date
ROW_PLAIN = r"(\d{1,4})\s+(" + NAME_WORDS + r")\s+(" + DMY + r")\s+(.+?)\s+(" + DMY + r")"
# number, name, birth date, person id, sport, submission date
ROW_WITH_ID = (
    r"(\d{1,4})\s+(" + NAME_WORDS + r")\s+(" + DMY + r")\s+(\d{4,7})\s+(.+?)\s+(" + DMY + r")"
)
ROW_NUMBER = r"(?U)^\s*\d{1,4}\s+"
TABLE_HEADER = r"(?iuU)(?:№\s+ФИО|№\s+п/?п\s+ФИО|Фамилия.*Имя.*Отчество)"
# Every header line has one of these in either case.
HEADER_LETTERS = ("№", "ф")
COLUMN_NUMBERS = r"(?U)^\d(\s+\d){2,}$"
PAGE_FOOTER_LINE = r"(?iuU)(?:Документ\s+зарегистрирован|Страница\s+\d+\s+из\s+\d+)"
# A footer line has, in either case, all letters of one of these sets. None of them has a
# third form that the pattern would accept.
FOOTER_LETTERS = ("гзм", "ц")
PAGE_FOOTER_START = "Документ"
PAGE_FOOTER_BLOCK = (
    r"(?U)Документ\s+зарегистрирован[^\n]*\nСтраница\s+\d+\s+из\s+\d+[^\n]*\n?"
)
LEAD_LINES = ("Приложение к", "Список лиц")
CATEGORY_HINT = r"(?iu)(?:судья|разряд|категори|КМС|МС|мастер|специалист)"
CATEGORY_START = r"(?iu)(?:судья|разряд|КМС|МС|мастер|специалист|кандидат)"
# Letters, in either case, of each word of the patterns; none of them has a third form.
CATEGORY_START_LETTERS = ("уья", "рзя", "м", "пци", "кни")
CATEGORY_NOISE_LETTERS = ("гку", "мпк", "_", "плж", "плц", "зрг")
CATEGORY_NOISE = r"(?iuU)(?:ГКУ|Москомспорт|___|Приложение|от\s+_|Список\s+лиц|зарегистрирован)"
CATEGORY_NOT_CONTINUED = r"(?U)^\d|^[Сс]портивный|^[Кк]андидат|^[Мм]астер"
ANY_NAME = r"(?U)[А-ЯЁA-Z][а-яёa-z]+(?:\s+[А-ЯЁA-Za-z][а-яёa-z]+){1,4}"
ANY_DATE = r"(?U)\d{2}\.\d{2}\.\d{4}"
FREE_NAME = r"[А-ЯЁ][а-яё]+\s+[А-ЯЁ][а-яё]+(?:\s+[А-ЯЁа-яё][а-яё]+){0,3}"
FREE_HEAD = r"(" + FREE_NAME + r")[,\s]+(" + DMY + r")\s*(?:г\.?\s*р\.?)?[,\s—–-]+"
FREE_ENTRY = (
    r"(?sU)" + FREE_HEAD + r"(.+?)(?=\s*(?:" + FREE_NAME + r"[,\s]+" + DMY + r"|\z))"
)
CONTEXT_PHRASE = r"(?U)[А-ЯЁа-яё]+(?:\s+[а-яё]+){0,3}"
GARBAGE_NAME = r"(?iu)(?:Приложение|Список|Приказ|категори|разряд)"
REPEAT_MARK = r'(?iuU)^\s*(?:-\s*[«"]?\s*-|то\s+же|—\s*[«"]?\s*—|-\s*//\s*-)\s*$'
AWARD_LINE = r"(?U)([А-ЯЁ][а-яё]+(?:\s+[А-ЯЁ][а-яё]+)*)\s*-\s*(.+)"
TABLE_LAYOUT_SOURCES = ["moskva_tstisk", "moskva_moskumsport"]

# --- readable characters ----------------------------------------------------
READABLE = (
    "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЁабвгдежзийклмнопрстуфхцчшщъыьэюяё"
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    + WHITESPACE + ".,;:-()\"'«»№/"
)

# --- pages ------------------------------------------------------------------
HREF_PDF = r"""href=["']([^"']*\.pdf)["']"""
HREF_ANY = r"""href=["']([^"']+)["']"""
ORDER_NUMBER_IN_PAGE = r"(?U)[№N]\s*([А-Яа-яA-Za-z0-9\-/]+)"
ORDER_DATE_IN_PAGE = r"(?U)(\d{2}[.\s]\d{2}[.\s]\d{4})"
CHALLENGE_MARKERS = [
    "servicepipe", "ddos-guard", "cloudflare", "checking your browser",
    "проверка браузера", "just a moment", "enable javascript",
]
ALLOWED_HOSTS = [
    "www.mos.ru", "mos.ru", "mst.mosreg.ru", "kfis.gov.spb.ru",
    "minsport.krasnodar.ru", "msrfinfo.ru",
]

# --- sport names ------------------------------------------------------------
SPORT_ALIASES = [
    ("Тайский бокс", "Муайтай"),
    ("Тай бокс", "Муайтай"),
    ("Водное поло", "Водное поло"),
    ("Кёрлинг", "Керлинг"),
    ("Спортиваня акробатика", "Спортивная акробатика"),
    ("Спортивнаяакробатика", "Спортивная акробатика"),
    ("Кёкусин", "Киокусинкай"),
    ("Лёгкая атлетика", "Легкая атлетика"),
    ("Художественая гимнастика", "Художественная гимнастика"),
    ("Спортивнаягимнастика", "Спортивная гимнастика"),
    ("Настольный тенис", "Настольный теннис"),
    ("Вольная борьба", "Спортивная борьба"),
    ("Греко-римская борьба", "Спортивная борьба"),
    ("ФМ", "Функциональное многоборье"),
]
REGISTRY_SHEETS = {"Признанные": 1, "Общероссийские": 2, "Национальные": 3, "Прикладные": 4}

# --- reference dictionaries -------------------------------------------------
SPECIALIST_POSITIONS = [
    ("admin_tp", "администратор тренировочного процесса"),
    ("analitik", "аналитик"),
    ("vrach", "врач по спортивной медицине"),
    ("instruktor_sport", "инструктор по спорту"),
    ("instruktor_adapt", "инструктор по адаптивной физической культуре"),
    ("massazhist", "массажист"),
    ("mekhanic", "механик"),
    ("nauchniy", "научный сотрудник"),
    ("perevodchik_rzhya", "переводчик русского жестового языка"),
    ("psiholog", "психолог"),
    ("specialist_ad", "специалист по антидопинговому обеспечению"),
    ("specialist_pitanie", "специалист по спортивному питанию"),
    ("specialist_video", "специалист по видеоанализу"),
    ("khoreograf", "хореограф"),
    ("fizioterapevt", "физиотерапевт"),
]
HONORARY_TITLES = [
    ("zms", "заслуженный мастер спорта России"),
    ("ztr", "заслуженный тренер России"),
    ("pochetniy_sudya", "почетный спортивный судья России"),
    ("pochetniy_master", "почетный мастер спорта России"),
    ("pochetniy_trener", "почетный тренер России"),
]
RANKS = [
    ("msmk", "мастер спорта россии международного класса", "звание", 5),
    ("ms", "мастер спорта россии", "звание", 10),
    ("gmr", "гроссмейстер россии", "звание", 8),
    ("kms", "кандидат в мастера спорта", "разряд", 20),
    ("1sr", "первый спортивный разряд", "разряд", 30),
    ("2sr", "второй спортивный разряд", "разряд", 40),
    ("3sr", "третий спортивный разряд", "разряд", 50),
    ("1ysr", "первый юношеский спортивный разряд", "юношеский_разряд", 60),
    ("2ysr", "второй юношеский спортивный разряд", "юношеский_разряд", 70),
    ("3ysr", "третий юношеский спортивный разряд", "юношеский_разряд", 80),
]
# dictionary -> (source document, effective from)
DICTIONARY_BASIS = {
    "specialist_positions": ("Приказ №838 от 19.10.2022", "2022-10-19"),
    "honorary_titles": ("Приказ №856 от 24.10.2022", "2022-10-24"),
    "ranks": ("Приказ №173 от 03.03.2025", "2025-03-03"),
}

# --- built-in sources -------------------------------------------------------
# One JSON-like record per source; keys follow schemas.SOURCE.
SOURCES = [
    {
        "code": "moskva_tstisk", "name": "ГКУ «ЦСТиСК» Москомспорта",
        "region": "г. Москва", "risk_class": "amber", "active": True,
        "source_type": "pdf_portal", "official_basis": "8-ФЗ",
        "download": {"method": "playwright", "base_url": "https://www.mos.ru",
                     "antibot": "servicepipe", "delay_min": 2.0, "delay_max": 6.0,
                     "wait_selector": "a[href$='.pdf']"},
        "detect": {
            "list_urls": [
                "https://www.mos.ru/moskomsport/documents/prisvoenie-sportivnykh-razryadov-po-vidam-sporta/",
                "https://www.mos.ru/moskomsport/documents/prisvoenie-kvalifikatsionnykh-kategoriy-sportivnykh-sudey/",
            ],
            "link_regex": r"""href=["']([^"']*view/\d+[^"']*)["']""",
            "title_regex": r">([^<]*(?:Приказ|Распоряжение)[^<]*)<",
            "order_date_regex": r"(?U)от\s+(\d{1,2}[.\s]\d{2}[.\s]\d{4})",
            "order_number_regex": r"(?U)[№N]\s*(\S+)",
            "max_pages": 1,
        },
        "meta": {"issuing_body": "ГКУ «ЦСТиСК» Москомспорта", "order_type": "приказ"},
    },
    {
        "code": "moskva_moskumsport", "name": "Департамент спорта города Москвы (Москомспорт)",
        "region": "г. Москва", "risk_class": "amber", "active": True,
        "source_type": "pdf_portal", "official_basis": "8-ФЗ",
        "download": {"method": "playwright", "base_url": "https://www.mos.ru",
                     "antibot": "servicepipe", "delay_min": 2.0, "delay_max": 6.0,
                     "wait_selector": "a[href$='.pdf']"},
        "detect": {
            "list_urls": [
                "https://www.mos.ru/moskomsport/documents/prisvoenie-sportivnykh-razryadov-po-vidam-sporta/",
            ],
            "link_regex": r"""href=["']([^"']*view/\d+[^"']*)["']""",
            "title_regex": r">([^<]*Распоряжение[^<]*)<",
            "max_pages": 1,
        },
        "meta": {"issuing_body": "Департамент спорта города Москвы (Москомспорт)",
                 "order_type": "распоряжение"},
    },
    {
        "code": "mo_mособлспорт", "name": "Министерство физической культуры и спорта Московской области",
        "region": "Московская область", "risk_class": "red", "active": True,
        "source_type": "pdf_portal", "official_basis": "8-ФЗ",
        "download": {"method": "playwright", "base_url": "https://mst.mosreg.ru",
                     "antibot": "servicepipe", "delay_min": 3.0, "delay_max": 8.0,
                     "wait_selector": "a.document-link, a[href$='.pdf']"},
        "detect": {
            "list_urls": [
                "https://mst.mosreg.ru/dokumenty/prisvoenie-sportivnykh-razryadov-kandidat-v-mastera-sporta-i-pervyi-sportivnyi-razryad",
            ],
            "link_regex": r"""href=["']([^"']*(?:rasporiaz|prikaz)[^"']*)["']""",
            "pagination": "?page={n}", "max_pages": 3,
        },
        "meta": {"issuing_body": "Министерство физической культуры и спорта Московской области",
                 "order_type": "распоряжение"},
    },
    {
        "code": "spb_kfkis", "name": "Комитет по физической культуре и спорту Санкт-Петербурга",
        "region": "г. Санкт-Петербург", "risk_class": "green", "active": True,
        "source_type": "pdf_portal", "official_basis": "8-ФЗ",
        "download": {"method": "httpx", "base_url": "https://kfis.gov.spb.ru",
                     "delay_min": 1.0, "delay_max": 3.0},
        "detect": {
            "list_urls": ["https://kfis.gov.spb.ru/docs/?type=54"],
            "link_regex": r"""href=["']([^"']*?(?:/docs/\d+|/documents/\d+)[^"']*)["']""",
            "title_regex": r"""class=["']doc-title["'][^>]*>([^<]+)<""",
            "pagination": "&page={n}", "max_pages": 3,
        },
        "meta": {"issuing_body": "Комитет по физической культуре и спорту Санкт-Петербурга",
                 "order_type": "распоряжение"},
    },
    {
        "code": "krasnodar_minsport", "name": "Министерство физической культуры и спорта Краснодарского края",
        "region": "Краснодарский край", "risk_class": "green", "active": True,
        "source_type": "pdf_portal", "official_basis": "8-ФЗ",
        "download": {"method": "httpx", "base_url": "https://minsport.krasnodar.ru",
                     "delay_min": 1.0, "delay_max": 4.0},
        "detect": {
            "list_urls": ["https://minsport.krasnodar.ru/activities/sport/prisvoenie-sportivnyx-razryadov/"],
            "link_regex": r"""href=["']([^"']*\.pdf)["']""",
            "max_pages": 1,
        },
        "meta": {"issuing_body": "Министерство физической культуры и спорта Краснодарского края",
                 "order_type": "приказ"},
    },
    {
        "code": "rf_minsport", "name": "Министерство спорта Российской Федерации",
        "region": "Россия", "risk_class": "green", "active": False,
        "source_type": "json_embed", "official_basis": "329-ФЗ",
        "download": {"method": "httpx", "base_url": "https://msrfinfo.ru",
                     "delay_min": 1.0, "delay_max": 2.0},
        "detect": {
            "list_urls": ["https://msrfinfo.ru/awards/"],
            "link_regex": r"""href=["']([^"']*\.pdf)["']""",
            "js_var": "$obj", "max_pages": 1,
        },
        "meta": {"issuing_body": "Министерство спорта Российской Федерации", "order_type": "приказ"},
    },
]
