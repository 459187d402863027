"""Listing sources and sinks."""

from vitrine.sources.driver_tables import listing_view
from vitrine.sources.ingest import (
    IngestReport,
    MissingColumnError,
    ingest_listings,
    nest_listing,
    quarantine,
    read_listing_documents,
    read_listings_csv,
    read_listings_json,
    reject_counts,
    rejected_row_count,
    type_listings,
    with_defaults,
    write_listings_json,
    write_listings_parquet,
    write_listings_with_quarantine,
)
from vitrine.sources.schema import LISTING_SCHEMA, RAW_COLUMNS, RAW_SCHEMA
from vitrine.sources.store import listings

__all__ = [
    "IngestReport",
    "LISTING_SCHEMA",
    "MissingColumnError",
    "RAW_COLUMNS",
    "RAW_SCHEMA",
    "ingest_listings",
    "listing_view",
    "listings",
    "nest_listing",
    "quarantine",
    "read_listing_documents",
    "read_listings_csv",
    "read_listings_json",
    "reject_counts",
    "rejected_row_count",
    "type_listings",
    "with_defaults",
    "write_listings_json",
    "write_listings_parquet",
    "write_listings_with_quarantine",
]
