"""Lakehouse data jobs written with DataFrame, Spark SQL and Structured Streaming operators."""

from tidemark.session import build_session, shared_folder

__all__ = ["build_session", "shared_folder"]
