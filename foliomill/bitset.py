"""Bloom filters of 64-bit hashes, made by Spark and held by tasks to keep rows that can't matter out of a shuffle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots a member takes.
TAKEN = 3


def fitting_bits(members: int, least: int = 20, most: int = 28) -> int:
    """A power of two of slots for so many members, about ten each; never more than 2^most (2^(most - 3) bytes).

    Fuller filters let more rows pass, up to all, with the same result after the exact join.
    """
    return min(most, max(least, (10 * max(1, members)).bit_length()))


def make(df: DataFrame, member: Column, bits: int) -> np.ndarray:
    """The filter as 2^(bits - 6) words of 64 slots, at most all of which come to the driver."""
    first, step = (x.bitwiseAND((1 << bits) - 1) for x in (member, F.shiftrightunsigned(member, 32)))
    slots = F.explode(F.array(*[(first + step * i) % (1 << bits) for i in range(TAKEN)]))
    words = df.select(slots.alias("s")).groupBy(F.expr("s div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("m")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["w"].to_numpy()] = words["m"].to_numpy()
    return out


def holds(words: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Which members a filter holds, or may hold."""
    mask = 64 * len(words) - 1
    first, step = members & mask, (members >> 32) & mask
    found = np.ones(len(members), bool)
    for i in range(TAKEN):
        slots = (first + step * i) & mask
        found &= (words[slots >> 6] >> (slots & 63)) & 1 == 1
    return found


def members_at(words: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Where members stand that a filter holds, or may hold; quicker than ``holds`` where it holds few."""
    mask, at = 64 * len(words) - 1, np.arange(len(members))
    for i in range(TAKEN):
        left = members[at]
        slots = ((left & mask) + ((left >> 32) & mask) * i) & mask
        at = at[(words[slots >> 6] >> (slots & 63)) & 1 == 1]
    return at
