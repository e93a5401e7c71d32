"""Address-registry analytics on Spark DataFrames."""

from addrspark.registry import Registry

__all__ = ["Registry"]
