"""Row shaping that keeps costly expressions from being evaluated twice.

Catalyst copies a computed column into every filter and projection above it, and derives a filter from
the input of an inner explode. For cheap expressions that is right; for a page's extraction or
chunking it doubles the work. A generator is a barrier to both, and an outer one derives no filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and the given columns, each evaluated exactly once per row."""
    row = F.struct(*(value.alias(name) for name, value in columns.items()))
    return df.select(*keep, F.inline_outer(F.array(row)))


def explode_present(df: DataFrame, keep: list[str], items: Column, position: str, item: str) -> DataFrame:
    """One row per non-null item of an array, with its position. Null and empty arrays give no row."""
    return df.select(*keep, F.posexplode_outer(items).alias(position, item)).where(F.col(item).isNotNull())
