"""Formats, word lists and limits that results depend on, stated once."""

# Line format of the syslog prefix: month, day, time, host, service, process id, message.
SYSLOG_PREFIX = (
    r"^([A-Z][a-z]{2})\s+(\d{1,2})\s+(\d{2}:\d{2}:\d{2})\s+(\S+)\s+([^\[]+)\[(\d+)\]:\s+(.*)$"
)

# Month abbreviations in calendar order.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Severity markers, strongest level first; a message that has none of them is INFO.
SEVERITY_MARKERS = (
    ("CRITICAL", ("possible break-in attempt", "too many authentication failures")),
    (
        "ERROR",
        (
            "failed password",
            "authentication failure",
            "fatal",
            "error",
            "invalid user",
            "user unknown",
        ),
    ),
    ("WARNING", ("disconnect", "closed by", "preauth", "reverse mapping")),
)
DEFAULT_LEVEL = "INFO"
LEVELS = ("CRITICAL", "ERROR", "WARNING", "INFO")
ALL_LEVELS = "ALL"
PROBLEM_LEVELS = ("ERROR", "CRITICAL", "WARNING")

# Defaults of the stored tables.
SOURCE_NAME = "OpenSSH"
LOG_YEAR = 2024
UNKNOWN_EVENT = "UNKNOWN"

# Column lists of the stored log table and of a search result.
LOG_COLUMNS = (
    "line_id",
    "source",
    "log_timestamp",
    "month",
    "day",
    "time_text",
    "host",
    "service",
    "process_id",
    "level",
    "event_id",
    "raw_message",
    "normalized_message",
    "event_template",
)
RESULT_COLUMNS = (
    "id",
    "line_id",
    "log_timestamp",
    "level",
    "event_id",
    "raw_message",
    "event_template",
)

# Request domains and defaults.
DEFAULT_TOP_K = 20
MAX_TOP_K = 200
MAX_MODEL_TOP_K = 50
MODEL_TOP_K = 10
MIN_CANDIDATES = 20
DEFAULT_GROUP_LIMIT = 15
MAX_GROUP_LIMIT = 100
CANDIDATE_LIMIT = 500
CANDIDATE_LIMIT_RANGE = (10, 5000)
EVENT_SEARCH_TOP_K = 200
MAX_EVENTS = 5
GRANULARITIES = ("hour", "day")

# Weights of the top-k quality score.
SIMILARITY_WEIGHT = 0.65
SHARE_WEIGHT = 0.35
QUALITY_METHOD = "proxy_similarity_event_concentration"

# Vectors: size in production, rows per encoding batch, decimals of the text literal.
VECTOR_DIMENSION = 384
ENCODE_BATCH = 128
COMPARISON_BATCH = 64
LITERAL_DECIMALS = 10

# Short encoder names and the full names they stand for.
MODEL_ALIASES = (
    ("all-MiniLM-L6-v2", "sentence-transformers/all-MiniLM-L6-v2"),
    ("multi-qa-MiniLM-L6-cos-v1", "sentence-transformers/multi-qa-MiniLM-L6-cos-v1"),
    ("all-mpnet-base-v2", "sentence-transformers/all-mpnet-base-v2"),
)
