"""Helpers that several operators use: the shared folder, stored tables, byte-level words."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.storage import shared_dir, shared_path, stored

__all__ = ["WORD_SPACE", "byte_slices", "filtered", "give_back", "named", "packed", "rows_and_text", "shared_dir", "shared_path", "stored", "trimmed"]

WORD_SPACE = r"[\x20\x09-\x0D]+"


def packed(docs: DataFrame) -> DataFrame:
    """``row``: each row as one struct, so that no name of its columns can clash with another."""
    return docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row"))


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Columns of ``df`` under new names. They are told apart exactly, and the first of equal names
    counts, so that no other column's name can clash with them."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{df.columns.index(old)}").alias(new) for new, old in columns.items()])


def rows_and_text(docs: DataFrame, text_col: str, without: tuple[str, ...] = ()) -> DataFrame:
    """``row`` and ``text``, never null: each row as one struct, but for columns whose names, in any case, are among
    ``without``. Columns are taken by position, so that names that differ by case alone don't clash."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in without]
    return plain.select(F.struct(*own).alias("row"), F.coalesce(F.col(f"c{docs.columns.index(text_col)}"), F.lit("")).alias("text"))


def give_back() -> None:
    """Returns memory that a worker's allocators keep to the system: a worker lives on after its task,
    and shares its executor's memory with all that comes then."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # of the C library of Linux alone
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of batches that gives memory back after each of them."""

    def careful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out
            del out
            give_back()
        give_back()

    return careful


def filtered(docs: DataFrame, keep: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``docs`` without the rows that ``keep`` takes out of its batches. Columns go through Arrow under
    plain names, by position, and get their own back, whatever those are."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(trimmed(keep), plain.schema).toDF(*docs.columns)


def byte_slices(payload: bytes, limit: int):
    """``payload`` in order, cut at ASCII white space into slices of about ``limit`` bytes."""
    start, size = 0, len(payload)
    while size - start > limit:
        cut = max(payload.rfind(space, start, start + limit) for space in (b" ", b"\n", b"\t", b"\r"))
        if cut <= start:
            cut = min((x for x in (payload.find(space, start + limit) for space in (b" ", b"\n", b"\t", b"\r")) if x >= 0), default=size)
        yield payload[start:cut]
        start = cut
    yield payload[start:]
