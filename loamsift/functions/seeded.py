"""Random numbers that depend on a seed and the row alone.

They give the same draw whatever the partitioning, and survive a retried task.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_HEX_DIGITS = 13  # 52 bits, exact in a double


def uniform(seed: int | str, *parts: Column) -> Column:
    """A number in [0, 1) from the md5 of ``seed:part:part…``."""
    key = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    bits = F.conv(F.substring(F.md5(key), 1, _HEX_DIGITS), 16, 10).cast("double")
    return bits / F.lit(float(16**_HEX_DIGITS))
