"""Small array expressions used on one decoded block at a time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slice0(arr: Column, start: Column | int, length: Column | int) -> Column:
    """Elements ``[start, start + length)`` of ``arr`` with a 0-based start."""
    start = F.lit(start) if isinstance(start, int) else start
    length = F.lit(length) if isinstance(length, int) else length
    return F.slice(arr, start + 1, length)


def first_geq(postings: Column, doc_id: Column, key: str = "doc_id") -> Column:
    """First struct of ``postings`` (sorted by ``key``) whose ``key`` >= doc_id,
    NULL if none. Blocks hold at most 64 postings, so a scan is as good as a
    binary search here."""
    return F.get(F.filter(postings, lambda p: p[key] >= doc_id), 0)
