"""Names, schemas and constants shared by all modules."""

# The ordered model inputs of the feature table.
FEATURES = [
    "domain_age_days",
    "secure_percentage",
    "has_umbrella_rank",
    "umbrella_rank",
    "has_tls",
    "tls_valid_days",
    "url_length",
    "subdomain_count",
]

# The 0/1 flags among them; every other feature is z-scored.
FLAGS = ["has_umbrella_rank", "has_tls"]
CONTINUOUS = [name for name in FEATURES if name not in FLAGS]

# Defaults for documents without a rank or a certificate.
UNRANKED = 999999
NO_TLS_DAYS = 0

# Seed of every draw, and the split fractions.
SEED = 42
VAL_SIZE = 0.15
TEST_SIZE = 0.15

# Sitemap limits and the namespace a sitemap must declare.
MAX_INDEX_DEPTH = 2
MAX_INDEX_CHILDREN = 5
URLS_PER_DOMAIN = 10
DOMAINS_PER_RUN = 50
SITEMAP_NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"

# Scan batches and waiting times in seconds.
BATCH_SIZE = 200
MAX_WAIT_SINGLE = 60
MAX_WAIT_BATCH = 300

# Largest answer of a stored-scan search.
SEARCH_CAP = 10000
SEARCH_DEFAULT = 100

# Class names in reports and in scored rows.
REPORT_NAMES = {0: "Legitimate", 1: "Phishing"}
LABEL_PHISHING = "PHISHING"
LABEL_LEGITIMATE = "LEGITIMATE"
LABEL_ERROR = "ERROR"

SCAN_DDL = (
    "original_url STRING, "
    "page STRUCT<domain: STRING, domainAgeDays: BIGINT, umbrellaRank: BIGINT, tlsValidDays: BIGINT>, "
    "stats STRUCT<securePercentage: DOUBLE>, "
    "task STRUCT<url: STRING, uuid: STRING>, "
    "verdicts STRUCT<overall: STRUCT<score: INT, malicious: BOOLEAN>>"
)

FEED_DDL = "url_id BIGINT, url STRING, is_phishing INT"
RANKED_DDL = "domain STRING, rank INT"
PROGRESS_DDL = "domain STRING, time_updated TIMESTAMP, urls ARRAY<STRING>"
LEGIT_URL_DDL = "is_phishing INT, url STRING, id BIGINT"
ATTEMPTS_DDL = "url STRING, status STRING, timestamp TIMESTAMP"
