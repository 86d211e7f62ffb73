"""Expressions shared by the operators: words, white space, case and row identity.

Words are runs of anything but the six ASCII white-space characters; only A-Z are lower-cased.
"""

from __future__ import annotations

import ctypes
import functools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# The white space between words, as a regex class and as characters.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

BROADCAST_ROWS = 200_000  # narrow rows only: a few MB


def text_of(text: Column | str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def without_space(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. ``lower`` does just that on ASCII text, and much faster than ``translate``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast only if it has at most ``rows`` rows. Pass narrow, written tables."""
    return F.broadcast(df) if df.count() <= rows else df


def boxed(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """Each row as one value ``_row`` beside working columns, whose names then can't clash with its own."""
    return docs.select(F.struct("*").alias("_row"), *columns)


def releasing(batches_to_batches):
    """The same generator of batches, whose worker gives memory back to the system once a task is done.

    Workers are used again for other tasks, and what allocators keep for one kind of task is of no use to the next.
    """

    @functools.wraps(batches_to_batches)
    def wrapped(batches):
        try:
            yield from batches_to_batches(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library keeps its own counsel
                pass

    return wrapped
