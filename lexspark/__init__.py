"""Corpus-to-tables operators and cross-dataset analytics for PySpark."""

from lexspark.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
