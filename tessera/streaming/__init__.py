"""Incremental file ingestion (Structured Streaming), see :mod:`tessera.streaming.files`."""
