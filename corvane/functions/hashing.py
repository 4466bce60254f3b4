"""Deterministic hashes for sampling and splitting."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded(seed: str, key: Column) -> Column:
    """SHA-256 of the seed, a zero byte and the key, in hexadecimal."""
    return F.sha2(F.concat(F.lit(seed + "\0"), key).cast("binary"), 256)


def threshold(share: float) -> str:
    """The least hash, in hexadecimal, whose ratio to 2**256 rounds to at least `share`.

    Hashes compare as strings of equal length, so no number of 256 bits is needed in a plan.
    """
    low, high = 0, 1 << 256
    while low < high:
        middle = (low + high) // 2
        if middle / 2**256 >= share:
            high = middle
        else:
            low = middle + 1
    return format(low, "064x")


def split(digest: Column, train: float = 0.9, validation: float = 0.05) -> Column:
    """train, validation or test by where the hash falls."""
    if not 0 < train <= 1 or not 0 <= validation <= 1 or train + validation > 1:
        raise ValueError("shares must satisfy 0 < train <= 1, 0 <= validation and train + validation <= 1")
    first, second = threshold(train), threshold(train + validation)
    return F.when(digest < first, "train").when(digest < second, "validation").otherwise("test")


def canonical(value: Any) -> str:
    """JSON with sorted keys and without NaN; equal values have equal text."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False, allow_nan=False)


def identity(value: Any) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()
