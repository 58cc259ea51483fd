"""Portable randomness: every draw is a hash of a salt and the row's own key.

The result does not depend on partitioning, retries or the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def draw(salt: str, *keys: Column | str) -> Column:
    """32 hexadecimal digits, uniform over rows."""
    return F.md5(F.concat_ws("|", F.lit(salt), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]))


def uniform(salt: str, *keys: Column | str) -> Column:
    """Number in [0, 1) from the first 32 bits of the draw."""
    return F.conv(F.substring(draw(salt, *keys), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
