"""Formulas of benchmark reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds(text) -> Column:
    """A timing cell as a number; ``-`` and anything else that is no number is NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast("double")


def speedup(base, variant) -> Column:
    """How many times faster the variant is; NULL where either timing is missing or zero."""
    return F.try_divide(base, variant)


def effective_bandwidth(bytes_in, bytes_out, elapsed) -> Column:
    """GB/s read and written."""
    return F.try_divide(bytes_in + bytes_out, elapsed) / 1e9


def throughput(flops_per_item, items, elapsed) -> Column:
    """GFLOP/s."""
    return F.try_divide(flops_per_item * items, elapsed) / 1e9
