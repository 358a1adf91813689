"""Readers: JSON envelopes, API payloads, CSV header aliases, HTML tables, cascades."""
