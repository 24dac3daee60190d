"""flowlens: network-flow analytics and attack classification on PySpark DataFrames."""

from .session import build_session

__all__ = ["build_session"]
