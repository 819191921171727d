"""Size, checksum, format, banding and timing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size cap in bytes, size bands in KiB, storage tiers in days, attempts,
# waiting times in seconds.
SIZE_CAP = 100 * 1024 * 1024
SIZE_BANDS = (("small", 1, 100), ("medium", 100, 1000), ("large", 1000, 10000),
              ("very_large", 10000, 50000))
INFREQUENT_AFTER_DAYS = 30
ARCHIVE_AFTER_DAYS = 90
MAX_ATTEMPTS = 3
FETCH_WAIT = (4, 10)
PROBE_WAIT = (2, 8)
REQUEST_DELAY = 0.25


def over_size_cap(length: Column, cap: int = SIZE_CAP) -> Column:
    """Strictly larger than the cap."""
    return length > cap


def content_checksum(content: Column) -> Column:
    """SHA-256 as lower-case hex."""
    return F.sha2(content, 256)


def pdf_check(content: Column, header_within: int = 1024) -> Column:
    """Structural test: PDF header in the leading kilobyte, end marker anywhere in the body.

    Weaker than a parser on purpose; pass another Column as validator where that matters.
    """
    head = F.substr(content, F.lit(1), F.lit(header_within))
    return F.contains(head, F.lit(b"%PDF-")) & F.contains(content, F.lit(b"%%EOF"))


def mebibytes(size: Column) -> Column:
    """Bytes as MiB, two decimals."""
    return F.round(size / F.lit(1048576.0), 2)


def size_band(size: Column) -> Column:
    """Name of the half-open size band; null outside all bands."""
    kib = size / F.lit(1024.0)
    bands = F.lit(None).cast("string")
    for name, low, high in reversed(SIZE_BANDS):
        bands = F.when((kib >= low) & (kib < high), F.lit(name)).otherwise(bands)
    return bands


def storage_tier(downloaded_at: Column, as_of: Column) -> Column:
    """Tier by age in days: standard, infrequent, archive."""
    age = F.datediff(as_of, downloaded_at)
    return (
        F.when(age >= ARCHIVE_AFTER_DAYS, "archive")
        .when(age >= INFREQUENT_AFTER_DAYS, "infrequent")
        .otherwise("standard")
    )


def wait_seconds(attempt: Column, low: int = FETCH_WAIT[0], high: int = FETCH_WAIT[1]) -> Column:
    """Exponential wait before the attempt after this one, clipped to [low, high]."""
    return F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), F.pow(F.lit(2.0), attempt - 1)))


def next_attempt_at(
    attempt: Column, failed_at: Column, low: int = FETCH_WAIT[0], high: int = FETCH_WAIT[1]
) -> Column:
    """Planned time of the attempt that follows a failed one."""
    return failed_at + F.make_dt_interval(secs=wait_seconds(attempt, low, high).cast("decimal(18,6)"))


def epoch_timestamp(seconds: Column) -> Column:
    """Timestamp from epoch seconds with a fraction."""
    return F.timestamp_micros(F.round(seconds * F.lit(1e6)).cast("bigint"))
