"""Incremental listing ingest with Structured Streaming."""

from vitrine.streaming.ingest import read_listing_stream, stream_listings_csv

__all__ = ["read_listing_stream", "stream_listings_csv"]
