"""Readers: raw JSON-lines batches, Parquet snapshots, JDBC tables and the
raw listings derived from the supplied tables."""

from abode.sources.files import read_raw_jsonl, read_snapshot, split_raw_jsonl  # noqa: F401
from abode.sources.jdbc import read_jdbc  # noqa: F401
from abode.sources.tables import raw_listings, read_table  # noqa: F401
