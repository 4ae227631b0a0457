"""Reusable batch and streaming operators for post, event and interaction data on Spark.

Every operator takes and returns DataFrames.  Operators build plans and run no
actions, except the few whose purpose is to act (writing, publishing, caching,
running a stream); those say so.
"""

from tidemark.session import build_session, pin_session

__all__ = ["build_session", "pin_session"]
