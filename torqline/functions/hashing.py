"""Reproducible pseudo-random draws from row keys.

Hashes of the key, unlike ``rand()``, give a lost task the same rows when it runs again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from torqline import config as C


def _digest(key: Column, salt: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{salt}")))


def hash_integer(key: Column, salt: str) -> Column:
    """32-bit non-negative integer."""
    return F.conv(F.substring(_digest(key, salt), 1, 8), 16, 10).cast("long")


def hash_fraction(key: Column, salt: str) -> Column:
    """Number in [0, 1)."""
    return hash_integer(key, salt) / F.lit(4294967296.0)


def hash_prefix(key: Column, salt: str) -> Column:
    """Four hex digits; comparing them with a cut splits rows without a sort or a window."""
    return F.substring(_digest(key, salt), 1, 4)


def test_split(key: Column) -> Column:
    """True for the held-out fifth."""
    return hash_prefix(key, str(C.SEED)) < F.lit("3333")


def fold_of(key: Column, cuts: list[str], salt: str) -> Column:
    """Fold number from bands of the prefix; its salt must differ from the split's."""
    prefix = hash_prefix(key, salt)
    bands = F
    for number, cut in enumerate(cuts):
        bands = bands.when(prefix < F.lit(cut), F.lit(number))
    return bands.otherwise(F.lit(len(cuts)))


CV_CUTS = ["3333", "6666", "9999", "cccc"]
CALIBRATION_CUTS = ["5555", "aaaa"]
