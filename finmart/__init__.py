"""Retail-banking medallion analytics expressed as Spark DataFrame plans."""

from finmart.session import build_session

__all__ = ["build_session"]
