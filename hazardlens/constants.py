"""Texts, patterns and sizes that decide the results."""

# --- Fixed values -----------------------------------------------------------

# Star ratings that count as negative reviews.
NEGATIVE_STARS = ("1", "2")

# Review text and review list fields, in fallback order.
REVIEW_TEXT_FIELDS = ("reviewContent", "content", "buyerFeedback")
REVIEW_LIST_FIELDS = ("reviewList", "reviews", "evaViewList")
PAGE_TOTAL_FIELDS = ("totalPage", "maxPage")

# Control characters that make a review unusable (tab, LF and CR are allowed).
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"

# Every character that Unicode text stripping removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Callback wrapper around a review response; (?d) lets only LF end a line.
CALLBACK_WRAPPER = r"(?d)mtopjsonp\d+\((.+)\)$"

# Return codes in response envelopes (the spelling EXOIRED is the service's).
SUCCESS_CODE = "SUCCESS"
TOKEN_CODES = ("TOKEN_EXOIRED", "TOKEN_ILLEGAL")
BLOCK_CODE = "RGV587"
AUTH_CODES = ("USER_VALIDATE", "ILLEGAL", "FAIL_AUTH")

# Marker inside the first item id of the module that lists subcategories.
SUBCATEGORY_MARK = "#"

# Reviews per model call in pass 1 and 2, characters of a review per call,
# calls tried per batch, products per collection batch.
PASS1_BATCH = 40
PASS2_BATCH = 20
MAX_REVIEW_CHARS = 300
MAX_ATTEMPTS = 3
PRODUCTS_PER_BATCH = 3000

# What a review must clearly describe to be a hazard, and what alone makes it none; if unclear, 0.
HAZARD_CRITERIA = (
    "personal injury: pain, bleeding, rash, allergy, swelling, poisoning",
    "choking hazard (small parts for children)",
    "electric shock, short circuit, sparks, smoke, fire, explosion, or burning",
    "device or charger dangerously hot to the touch",
    "product melting or deforming in a way that causes smoke, fire, or burn risk — not just product failure",
    "chemical/toxic smell causing physical symptoms (headache, nausea, throat pain, eye irritation)",
    "product unsafe for food contact",
    "wrong voltage causing component failure or fire",
    "product bursting or rupturing during normal use",
)
HARMLESS_CRITERIA = (
    "broken, poor quality, wrong or fake product, stopped working",
    "property damage (printer, phone, car) without personal injury",
    "leaking, refund issue, seller problem",
    "discomfort from poor fit or normal use",
    "fraud, scam, misleading listing, or malware/software issues",
    "product getting warm during normal use",
    "phone or device overheating without fire, burn, or smoke",
    "product melted or warped by heat without fire or smoke",
    "bad or unpleasant odor without toxic concern",
)

# Label columns.
PASS1_LABEL = "hazard_label_classified"
PASS2_LABEL = "hazard_label_validated"

# --- End of fixed values ----------------------------------------------------
