"""The Bloom filters of ``foliomill.bitset``."""

from ..bitset import TAKEN, fitting_bits, holds, make

__all__ = ["TAKEN", "fitting_bits", "holds", "make"]
