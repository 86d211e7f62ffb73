"""Small declared weight tables as column expressions, so that no join is planned."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def weight_of(key: Column, weights: dict[str, float], default: float) -> Column:
    if not weights:
        return F.lit(float(default))
    pairs = [F.lit(x) for item in weights.items() for x in (item[0], float(item[1]))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(float(default)))
