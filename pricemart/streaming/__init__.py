"""Incremental processing of landed snapshots with Structured Streaming."""

from pricemart.streaming.snapshots import fold_latest, latest_version
