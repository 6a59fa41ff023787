"""Retail lake analytics on Spark: DataFrames in, DataFrames out."""

from .session import configure, local_session, shared_folder, workspace

__all__ = ["configure", "local_session", "shared_folder", "workspace"]
