"""Star-schema loading on Spark DataFrames: typed ingest, clean-up, keyed merge, publish."""

from starmart.warehouse import Warehouse

__all__ = ["Warehouse"]
