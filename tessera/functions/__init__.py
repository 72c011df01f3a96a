"""Scalar functions: ``Column -> Column`` built from Spark expressions."""

from tessera.functions import dates, strings, values  # noqa: F401
