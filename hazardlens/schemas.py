"""Fixed schemas; nothing is inferred from data."""

RAW_REVIEWS = "product_id string, subcategory string, review_text string"

LABELLED_REVIEWS = RAW_REVIEWS + ", hazard_label_classified int, hazard_label_validated int"

LABELS = "review_key string, label int, labelled_at timestamp"

SCORES = "text_hash string, scorer string, label int, labelled_at timestamp"

REVIEW_PAGES = (
    "product_id string, star string, page int, attempt int, ingest_ts timestamp, body string"
)

SEARCH_PAGES = (
    "category string, subcategory string, sub_ord int, page int, attempt int, body string"
)

CATEGORY_TABS = "tab_pos int, tab_id string, body string"

IDS = "category string, ordinal bigint, id string, subcategory string"

QUERY_MAP = "map<string,struct<subcategories:map<string,string>>>"
