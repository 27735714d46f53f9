"""What several operators of this folder need: staged tables and words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.staging import drop, free_shuffles
from ..functions.staging import stage as _stage

__all__ = ["WORD", "column", "drop", "free_shuffles", "give_back", "stage", "tidy", "unpacked", "whole_row", "word_count"]

#: White space as the contracts count it: blank, tab, line feed to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def stage(df: DataFrame, name: str) -> DataFrame:
    """A staged table whose joins Spark chooses by its size, as the operators here were measured."""
    return _stage(df, name, merge=False)


def word_count(text: Column) -> Column:
    """Number of runs of characters other than white space; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(names: Sequence[str]) -> list[Column]:
    """The columns as one struct `row`, out of reach of names that an operator uses; nothing for no names."""
    return [F.struct(*map(column, names)).alias("row")] if names else []


def unpacked(names: Sequence[str]) -> list[Column]:
    """The columns that whole_row() packed."""
    return [F.col("row").getField(n).alias(n) for n in names]


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """function over batches, after which a worker, which goes on to other tasks, gives back the memory that it freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass
