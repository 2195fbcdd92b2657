"""Fixed values that results depend on: names, cut-offs, weights, schemas."""

# --- scoring (fixed values) -------------------------------------------------
SEVERITY_CUTOFFS = [("Critical", 9.0), ("High", 7.0), ("Medium", 4.0)]
LOWEST_SEVERITY = "Low"
SEVERITY_WEIGHTS = {"Critical": "1.00", "High": "0.75", "Medium": "0.50", "Low": "0.25"}

# --- names and ids (fixed values) -------------------------------------------
MISSING_NAMES = ["", "n/a", "*** n/a ***"]
NON_ASCII = r"[^\x00-\x7F]"
HTML_TAG = r"<[^>]*>"
UNSAFE_PATH_CHARS = r"[^A-Za-z0-9._-]"
LEADING_PATH_MARKS = r"^[._-]+"
PATH_FALLBACK = "file"
UNSAFE_ID_CHARS = r"[^A-Za-z0-9_-]"
MESSAGE_ID_BASE_LENGTH = 67
MESSAGE_ID_HASH_LENGTH = 12
RAW_FILE_NAME = r"^(.+)_cve_(.+)_raw_(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})\.json$"
FILE_STAMP = "yyyy-MM-dd_HH-mm-ss"
INGEST_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# --- record schemas (fixed values) ------------------------------------------
INGEST_SCHEMA = (
    "ingestionDate string, ingestionTimestamp string, vendor string, product string, "
    "cveDataAvailable boolean, cvelistv5 array<array<string>>, fkie_nvd array<array<string>>"
)

_PROBLEM_TYPES = (
    "array<struct<descriptions:array<struct<"
    "cweId:string,description:string,lang:string,type:string>>>>"
)
_V31_METRICS = (
    "array<struct<cvssV3_1:struct<version:string,vectorString:string,baseScore:double>>>"
)
_TEXTS = "array<struct<lang:string,value:string>>"

CNA_SCHEMA = (
    "cveMetadata struct<cveId:string,datePublished:string,dateReserved:string,dateUpdated:string>, "
    "containers struct<cna:struct<"
    f"datePublic:string,descriptions:{_TEXTS},"
    f"impacts:array<struct<capecId:string,descriptions:{_TEXTS}>>,"
    f"metrics:{_V31_METRICS},problemTypes:{_PROBLEM_TYPES}"
    ",affected:array<struct<vendor:string,product:string>>>,"
    f"adp:array<struct<problemTypes:{_PROBLEM_TYPES},metrics:{_V31_METRICS}>>>"
)

NVD_SCHEMA = (
    "id string, published string, lastModified string, vulnStatus string, "
    f"descriptions {_TEXTS}, "
    "metrics map<string,array<struct<source:string,type:string,"
    "cvssData:struct<version:string,vectorString:string,baseScore:double>,"
    "exploitabilityScore:double,impactScore:double>>>, "
    f"weaknesses array<struct<source:string,type:string,description:{_TEXTS}>>, "
    "configurations array<struct<nodes:array<struct<cpeMatch:array<struct<criteria:string>>>>>>"
)

# Parts of the documents that staging reads; the bulky rest is skipped while parsing.
CNA_STAGING_SCHEMA = CNA_SCHEMA.replace(",affected:array<struct<vendor:string,product:string>>", "")
NVD_STAGING_SCHEMA = NVD_SCHEMA.rpartition(", configurations")[0]

CVSS_FIELDS = [
    ("source", "string"),
    ("type", "string"),
    ("version", "string"),
    ("vectorString", "string"),
    ("baseScore", "double"),
    ("impactScore", "double"),
    ("exploitabilityScore", "double"),
]
CVSS_STRUCT = "struct<" + ",".join(f"{n}:{t}" for n, t in CVSS_FIELDS) + ">"

STAGING_COLUMNS = [
    "ingestionDate", "vendor", "product", "cveId", "cweData", "capecData", "vulnStatus",
    "cvssData", "datePublished", "dateReserved", "dateUpdated", "datePublic", "lastModified",
    "Descriptions", "ingestionTimestamp",
]
MASTER_COLUMNS = [
    "vendor", "product", "cveId", "cweData", "capecData", "vulnStatus", "cvssData",
    "datePublished", "dateReserved", "dateUpdated", "datePublic", "lastModified",
    "descriptions", "validFrom", "validTo", "currentFlag", "cvssScore", "cvssVersion", "severity",
]
PROFILE_COLUMNS = [
    "vendor", "product", "cveId", "cweData", "capecData", "vulnStatus", "cvssData",
    "datePublished", "dateReserved", "dateUpdated", "datePublic", "lastModified", "Descriptions",
]
LOOKUP_COLUMNS = [
    "datePublished", "vendor", "product", "cveId", "descriptions", "cvssScore", "severity",
    "vectorString", "impactScore", "exploitabilityScore", "source", "sourceType", "cvssVersion",
    "vulnStatus", "cweData", "capecData", "cvssData", "dateReserved", "dateUpdated",
    "datePublic", "lastModified", "year_published", "date_published",
]
RECORD_KEY = ["vendor", "product", "cveId"]
WAREHOUSE_WIDTHS = {
    "vendor": 1024, "product": 1024, "cveId": 128, "vulnStatus": 128,
    "descriptions": 65535, "cvssVersion": 32, "severity": 32,
}

# --- feeds (fixed values) ---------------------------------------------------
KEV_FIELDS = [
    "cveID", "vendorProject", "product", "vulnerabilityName", "dateAdded", "shortDescription",
    "requiredAction", "dueDate", "knownRansomwareCampaignUse", "notes",
]
KEV_ITEM_SCHEMA = ", ".join(f"{c} string" for c in KEV_FIELDS)
EPSS_RAW_SCHEMA = "cve string, epss string, percentile string"

# --- exposure measures (fixed values) ---------------------------------------
SEVERITIES = ["critical", "high", "medium", "low"]
RISK_GROUPS = ["network", "no_ui", "low_priv", "fully_critical"]
RISK_FLAGS = [
    "is_network_based", "is_no_ui", "is_low_priv", "is_scope_changed",
    "is_high_conf", "is_high_int", "is_high_avail", "is_fully_critical",
]
LEVELS = ["global", "vendor", "product"]
GRAINS = ["daily", "monthly", "yearly"]
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}

# --- maintenance (fixed values) ---------------------------------------------
TARGET_FILE_BYTES = 134217728
BATCH_SIZE = 10
BUILD_BUFFER_HOURS = 72.0
EPOCH = "1970-01-01 00:00:00"
