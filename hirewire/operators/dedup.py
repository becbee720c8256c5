"""First-wins deduplication and the new-only anti-join.

First-wins is a ``min`` over the arrival-order columns alone: the aggregate runs map-side
before the shuffle, so a URL that holds a third of all rows is reduced to one narrow row
per input partition before it is exchanged (a ``row_number`` window would sort the whole
hot key in one task). The other columns are joined back by the winners' keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.functions.text import is_blank
from hirewire.functions import urls as U

def with_normalized_url(df: DataFrame, src: str = "url", out: str = "url") -> DataFrame:
    return U.with_normalized_url(df, src, out)


def quality_gate(df: DataFrame) -> Column:
    """K1: a usable row has a non-empty normalised url, a non-blank company and title."""
    url = F.col("url")
    return F.coalesce(url.isNotNull() & (url != "") & ~is_blank("company") & ~is_blank("title"), F.lit(False))


def first_keys(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """Per ``key`` the smallest ``order`` values; nulls come first."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_w")).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order])


def first_wins(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The rows of ``df`` that come first of their ``key``. ``order`` tells the rows of a key apart, as arrival
    order does; rows that agree in it are one arrival, and all of them stay. ``df`` is read twice, so what is
    dear to compute should be written first."""
    keys = [key] if isinstance(key, str) else list(key)
    firsts = first_keys(df, keys, order)
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for c in [*keys, *order]]
    return df.alias("d").join(firsts.alias("f"), same, "left_semi").select(*df.columns)


def new_only(batch: DataFrame, target_urls: DataFrame, key: str = "url") -> DataFrame:
    """K3: rows of ``batch`` whose key is not already stored.

    A plain anti-join on the key column of the stored table: Spark picks the join by the sizes it knows or
    sees at run time, and a hot key needs no care, as the batch has each key once."""
    stored = target_urls.select(F.col(key)).where(F.col(key).isNotNull())
    return batch.join(stored, key, "left_anti")
