"""Structured Streaming ingest of dropped report files (the reference's
"drop exports into the input folder" workflow, made incremental)."""

from skuflow.streaming.ingest import ingest_payloads, ingest_reports, latest_landed

__all__ = ["ingest_payloads", "ingest_reports", "latest_landed"]
