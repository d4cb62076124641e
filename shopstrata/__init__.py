"""Retail medallion engine on PySpark: raw drops to bronze, silver and gold tables."""

from shopstrata.lake import Lake
from shopstrata.session import build_session, scratch_folder

__all__ = ["Lake", "build_session", "scratch_folder"]
