"""Compute-once barrier for expensive derived columns.

Catalyst pushes a filter through projections by substituting aliases, so a filter on
a derived column (the country, the normalised URL) would re-evaluate the whole
derivation inside the Filter and again in the Project. Emitting the derived values
through a one-element ``inline`` (a Generate) stops that: filters on them stay
above, filters on the other columns still sink to the scan, and the generator is
codegen'd.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def materialize(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    keep = [c for c in df.columns if c not in cols]
    packed = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select(*keep, F.inline(F.array(packed)))
