"""Seeded, engine-independent hashing.

``md5('<seed>|<id>')`` is computed identically by Spark and by SQL engines,
so every seeded choice (shuffle order, split, sample, stand-in label) is
reproducible outside Spark and stable under task retry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_key(col: Column | str, seed: int = 42) -> Column:
    """32-hex-digit md5 of ``'<seed>|<id>'``; sorts like a uniform draw."""
    c = F.col(col) if isinstance(col, str) else col
    return F.md5(F.concat(F.lit(f"{seed}|"), c.cast("string")))


def seeded_int(col: Column | str, seed: int = 42) -> Column:
    """First 15 hex digits (60 bits) of the seeded md5 as a non-negative bigint."""
    return F.conv(F.substring(seeded_key(col, seed), 1, 15), 16, 10).cast("long")


def residue(col: Column | str, modulus: int, seed: int = 42) -> Column:
    """Deterministic residue in ``[0, modulus)``."""
    return F.pmod(seeded_int(col, seed), F.lit(modulus))


def seeded_unit(col: Column | str, seed: int = 42) -> Column:
    """Deterministic draw in ``[0, 1)``."""
    return seeded_int(col, seed) / F.lit(float(2 ** 60))
