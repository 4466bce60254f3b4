"""What several operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
import string
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.session import text_batches

#: A word: a run without space, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def lower_az(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def parts(rows: int, each: int) -> int:
    """How many parts of about `each` rows hold `rows` rows."""
    return max(1, -(-rows // each))


#: Bytes of text for each core below which texts are dealt out anew before Python works on them.
SMALL_TEXT = 16_000_000


def spread(texts: DataFrame, size: int) -> DataFrame:
    """Texts of `size` bytes together, dealt to all cores if they are so few that the input's files may hold them in fewer parts."""
    cores = texts.sparkSession.sparkContext.defaultParallelism
    return texts.repartition(cores) if size < cores * SMALL_TEXT else texts


_held: dict[str, Any] = {}


def hold(key: str, make: Callable[[], Any]) -> Any:
    """The one model that a Python worker keeps between tasks, whichever operator it belongs to."""
    if key not in _held:
        release()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Drop the model of a stage that is over and give freed memory back, since workers are used again for other stages."""
    if _held:
        _held.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library: its memory stays with the worker
        pass


def require(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, in order; all else that the input carries is left aside. Batches for Python get small."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    text_batches(df.sparkSession)
    return df.select(*names)
