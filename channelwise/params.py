"""Parameters, rule sets and fixed values.

Everything here is data, not logic: rule lists are ``[(label, [keyword, ...]), ...]``
evaluated in order, first match wins (see ``channelwise.functions.rules``).
"""

from __future__ import annotations

import datetime as _dt

# Default evaluation instant for every "now"-dependent function (UTC wall clock).
# Library functions take ``as_of`` explicitly; this is only the fixture/test default.
DEFAULT_AS_OF = _dt.datetime(2024, 1, 29, 12, 0, 0)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the behaviour being reproduced, so they are
# stated plainly and in their natural order.
# ---------------------------------------------------------------------------

# Channel classification (order matters: "med" is tested before "medical").
CHANNEL_TYPE_RULES = [
    ("Pharmaceutical", ["pharma", "med", "drug", "pharmacy", "pill", "tablet"]),
    ("Cosmetics", ["cosmetic", "beauty", "skin", "cream", "lotion", "makeup"]),
    ("Medical", ["health", "medical", "hospital", "clinic", "doctor"]),
]
CHANNEL_TYPE_DEFAULT = "Other"
CHANNEL_TYPES = ["Pharmaceutical", "Cosmetics", "Medical", "Other"]

# Product categories, report variant (rule set A).
PRODUCT_RULES_REPORT = [
    ("Tablets", ["tablet", "pill"]),
    ("Capsules", ["capsule"]),
    ("Topical", ["cream", "ointment"]),
    ("Liquids", ["syrup", "liquid"]),
    ("Injections", ["injection"]),
    ("Vitamins", ["vitamin"]),
    ("Supplements", ["supplement"]),
    ("Devices", ["device", "equipment"]),
    ("Medications", ["mg", "ml"]),
]
# The report's mention filter (it lacks "pill" and "liquid").
PRODUCT_FILTER_REPORT = [
    "mg", "ml", "tablet", "capsule", "cream", "ointment", "syrup", "injection",
    "vitamin", "supplement", "device", "equipment",
]

# Product categories, extract variant (rule set B).
PRODUCT_RULES_EXTRACT = [
    ("Tablets", ["tablet", "pill"]),
    ("Capsules", ["capsule"]),
    ("Creams/Ointments", ["cream", "ointment"]),
    ("Liquids", ["syrup", "liquid"]),
    ("Injections", ["injection"]),
    ("Vitamins", ["vitamin"]),
    ("Supplements", ["supplement"]),
    ("Medical Devices", ["device"]),
]

# Product categories, product-mart variant (rule set C).
PRODUCT_RULES_MART = [
    ("Tablets", ["tablet", "pill"]),
    ("Capsules", ["capsule"]),
    ("Topical", ["cream", "ointment"]),
    ("Liquids", ["syrup", "liquid"]),
    ("Injectables", ["injection", "injectable"]),
    ("Supplements", ["vitamin", "supplement"]),
    ("Medical Devices", ["device", "equipment"]),
]
PRODUCT_DEFAULT = "Other"

# Strength pattern of the product mart.
STRENGTH_PATTERN = r"\d+\s*(mg|ml|g)"

# Image classification object sets.
PERSON_OBJECTS = ["person"]
PRODUCT_OBJECTS = [
    "bottle", "cup", "bowl", "handbag", "backpack", "cell phone", "clock", "vase",
    "scissors", "book", "chair", "couch", "potted plant", "dining table",
]
MEDICAL_OBJECTS = ["bottle", "vase"]
# Per-box classification substrings.
BOX_PRODUCT_WORDS = ["bottle", "container", "packet"]

# Detector confidence threshold (strictly greater than).
DETECTION_THRESHOLD = 0.25

# Image extensions searched (lower case; upper case is matched too).
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "bmp", "gif", "webp"]

# Bucket thresholds.
PERFORMANCE_HIGH = 1000
PERFORMANCE_MEDIUM = 100
ACTIVE_DAYS = 7
MODERATE_DAYS = 30
RECOMMEND_IMAGE_PCT = 30
RECOMMEND_POSTS_7D = 5
RECOMMEND_AVG_VIEWS = 50

# Fixed date range of the declarative calendar.
CALENDAR_START = _dt.date(2024, 1, 1)
CALENDAR_END = _dt.date(2026, 12, 31)
CALENDAR_PAD_DAYS = 30

# Argument ranges.
LIMIT_MAX = 100
DAYS_MAX = 365
SEARCH_MIN_LENGTH = 2
MAX_MESSAGE_LENGTH = 10000
CHANNEL_SORT_FIELDS = ["total_posts", "avg_views", "last_post_date", "channel_name"]
