"""Declared schemas of every table, as DDL; nothing is ever inferred."""


DOWNLOAD = (
    "struct<method:string,base_url:string,antibot:string,delay_min:double,"
    "delay_max:double,wait_selector:string>"
)
DETECT = (
    "struct<list_urls:array<string>,link_regex:string,title_regex:string,"
    "order_date_regex:string,order_number_regex:string,pagination:string,"
    "max_pages:int,js_var:string>"
)
META = "struct<issuing_body:string,order_type:string>"

SOURCE = (
    "code string, name string, region string, federal_subject string, source_type string, "
    f"download {DOWNLOAD}, detect {DETECT}, meta {META}, official_basis string, "
    "risk_class string, active boolean, inn bigint, last_page_hash string, "
    "last_etag string, last_checked_at timestamp, created_at timestamp, updated_at timestamp"
)
ORDER = (
    "id string, source_id string, order_number string, order_date date, order_type string, "
    "title string, source_url string, file_url string, file_hash string, status string, "
    "error_message string, ocr_method string, ocr_confidence double, extracted_at timestamp, "
    "page_count int, parent_id string, attachment_num int, created_at timestamp, signed_by string"
)
ASSIGNMENT = (
    "id string, order_id string, row_no int, fio string, fio_normalized string, "
    "birth_date date, birth_date_raw string, ias_id int, submission_number string, "
    "assignment_type string, rank_category string, rank_category_original string, "
    "sport string, sport_original string, sport_id string, action string, "
    "extra_fields map<string,string>, llm_model string, confidence double, created_at timestamp"
)
LOG = (
    "id string, order_id string, source_id string, level string, stage string, "
    "message string, details map<string,string>, created_at timestamp"
)
QUALITY = (
    "id string, source_id string, measured_at timestamp, coverage double, ocr_rate double, "
    "field_completeness map<string,double>, avg_row_yield double, min_row_yield int, "
    "max_row_yield int, link_rot_rate double, avg_confidence double, sample_size int"
)
GOLDEN = (
    "id string, source_id string, order_id string, expected string, description string, "
    "record_count int, verified_by string, verified_at timestamp, active boolean, "
    "created_at timestamp"
)
REGISTRY_VERSION = (
    "id string, version_label string, source_file string, source_hash string, "
    "imported_at timestamp, sport_count int, discipline_count int, notes string"
)
SPORT = (
    "id string, code_base int, code_full string, section int, current_name string, "
    "active boolean, created_at timestamp, updated_at timestamp"
)
SPORT_NAME = (
    "id string, sport_id string, name string, name_normalized string, is_primary boolean, "
    "valid_from date, valid_to date, source_version_id string, created_at timestamp"
)
SPORT_DISCIPLINE = (
    "id string, sport_id string, name string, code_full string, active boolean, "
    "created_at timestamp"
)
PAGE = "url string, html string, etag string, source_code string, page_no int"
# One exported registry sheet row: ten cells, read as text.
REGISTRY_SHEET = (
    "sheet string, row_no int, c1 string, c2 string, c3 string, c4 string, c5 string, "
    "c6 string, c7 string, c8 string, c9 string, c10 string"
)
# One item of a model response, every scalar as text so that bad values survive parsing.
RESPONSE_ITEM = (
    "fio string, birth_date string, ias_id string, submission_number string, "
    "assignment_type string, rank_category string, sport string, sport_original string, "
    "action string, extra_fields map<string,string>"
)

TABLES = {
    "registry_sources": SOURCE,
    "orders": ORDER,
    "assignments": ASSIGNMENT,
    "processing_log": LOG,
    "quality_metrics": QUALITY,
    "golden_sets": GOLDEN,
    "sport_registry_versions": REGISTRY_VERSION,
    "sports": SPORT,
    "sport_names": SPORT_NAME,
    "sport_disciplines": SPORT_DISCIPLINE,
}
