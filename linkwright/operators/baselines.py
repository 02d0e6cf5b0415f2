"""Exact matchers: equal keys, no caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RAW = ("lower(trim(business_name))",)
NAME = ("name_norm",)
NAME_COUNTRY = ("name_norm", "country_norm")
NAME_ADDRESS = ("name_norm", "addr_norm", "country_norm")


def exact_match(s1: DataFrame, pool: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """s1_id, cand_id of equal keys; for names and addresses empty ones match nothing."""
    whole: Column = F.lit(True)
    for k in keys:
        if k != "country_norm":
            whole = whole & (F.expr(k) != "")
    side = lambda f, i: f.where(whole).select(F.col("entity_id").alias(i), *[F.expr(k).alias(f"k{n}") for n, k in enumerate(keys)])
    return side(s1, "s1_id").join(side(pool, "cand_id"), [f"k{n}" for n in range(len(keys))]).select("s1_id", "cand_id")
