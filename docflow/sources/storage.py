"""Locations. Credentials belong into the Hadoop configuration, never into a path."""

from __future__ import annotations


def storage_uri(kind: str, bucket: str = "", prefix: str = "", account: str = "") -> str:
    """URI of a folder in an object store or on a file system, as Spark's readers take it."""
    tail = prefix.strip("/")
    if kind in ("s3", "gcs"):
        root = {"s3": "s3a", "gcs": "gs"}[kind] + f"://{bucket}"
    elif kind == "azure":
        root = f"abfss://{bucket}@{account}.dfs.core.windows.net"
    elif kind == "local":
        return prefix.rstrip("/") or "/"
    else:
        raise ValueError(f"unknown storage kind: {kind}")
    if not bucket or (kind == "azure" and not account):
        raise ValueError(f"{kind} storage needs a bucket and, for azure, an account")
    return f"{root}/{tail}" if tail else root
