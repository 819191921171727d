"""Fixed schemas of the tables the operators read and write."""

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(),
    "BINARY": T.BinaryType(), "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(),
    "DOUBLE": T.DoubleType(),
}


def _struct(columns: str) -> T.StructType:
    """Flat schema from "name TYPE, ..."; unlike Spark's parser it needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PAGES = _struct("page_id BIGINT, url STRING, html STRING, status_code INT, error STRING")

# Header text as observed; `operators.change.head_observations` parses it.
HEADS = _struct("url STRING, content_length STRING, last_modified STRING, error STRING")

ATTEMPTS = _struct(
    "url STRING, attempt INT, ok BOOLEAN, error STRING, attempted_at TIMESTAMP"
)

BODIES = _struct("url STRING, content BINARY")

STORED = _struct("filename STRING, length BIGINT")

MANIFEST = _struct(
    "filename STRING, url STRING, size BIGINT, checksum STRING, last_modified STRING, "
    "downloaded_at TIMESTAMP, local_path STRING"
)

# One entry of the JSON form of the manifest, keyed there by file name.
MANIFEST_ENTRY = _struct(
    "url STRING, size BIGINT, checksum STRING, last_modified STRING, "
    "downloaded_at STRING, local_path STRING"
)

EVENTS = _struct(
    "run_id STRING, timestamp TIMESTAMP, event_type STRING, url STRING, file STRING, "
    "error STRING, size BIGINT, checksum STRING, pdf_count BIGINT, retry_count INT"
)

PAGE_PROFILE = _struct(
    "status STRING, url STRING, status_code INT, content_length BIGINT, title STRING, "
    "sample_text STRING, error STRING"
)

# A log entry as single-process runs wrote it: newer ones name the event in `event_type`,
# older ones in `stage`, without a time.
LOG_ENTRY = _struct(
    "timestamp DOUBLE, event_type STRING, stage STRING, url STRING, file STRING, error STRING, "
    "size BIGINT, checksum STRING, pdf_count BIGINT, retry_count INT"
)

# Observations as a stream delivers them: header fields, body and time of observation.
OBSERVATIONS = _struct(
    "url STRING, content_length STRING, last_modified STRING, error STRING, content BINARY, "
    "observed_at TIMESTAMP"
)

DOCUMENTS = _struct(
    "filename STRING, url STRING, checksum STRING, content BINARY, run_id STRING"
)

FOLDED_ATTEMPTS = _struct(
    "url STRING, ok BOOLEAN, attempts BIGINT, failures BIGINT, last_error STRING"
)
