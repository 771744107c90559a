"""Keyed, event-time analytics on PySpark DataFrames."""

from keyflow.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir"]
