"""textloom: text-corpus preparation as ordinary Spark DataFrame jobs."""

from textloom.session import build_session

__all__ = ["build_session"]
