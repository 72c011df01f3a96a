"""Readers (S*): SQL over catalog views, Parquet run datasets, CSV, JSON
lines, snapshots, projected reads, file selection, config-driven ingest,
nested run tables and mapping documents."""

from tessera.sources.readers import *  # noqa: F401,F403
