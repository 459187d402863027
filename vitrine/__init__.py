"""vitrine: marketplace-listing analytics on Spark DataFrames.

Layout
------
- ``vitrine.sources``    CSV ingest, typed nested schema, listing table over the
                         driver tables, JSON/Parquet sinks, the stored table.
- ``vitrine.functions``  column expressions (exact half-even rounding, guarded
                         ratios, case-insensitive match, sums that default to 0).
- ``vitrine.operators``  reusable distributed operators (top-k per group, argmax,
                         mode, leave-one-out, inequality/range/nearest joins,
                         exact order statistics, banding, nesting).
- ``vitrine.plans``      the fifteen analyses as DataFrame plans, plus the
                         equivalent DuckDB SQL used as an independent oracle.
- ``vitrine.streaming``  incremental CSV ingest with Structured Streaming.
"""

from vitrine.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
