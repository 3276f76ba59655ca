"""Card-transaction ingest, validation and normalisation on PySpark."""

from txnflow.session import configure

__all__ = ["configure"]
