"""Surrogate ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skuflow.functions.text import underscore_spaces


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """date -> ``yyyyMMdd``."""
    return F.date_format(_c(d), "yyyyMMdd")


def sku_channel_id(channel="Channel", sku="SKU", underscore: bool = True) -> Column:
    ch = underscore_spaces(_c(channel)) if underscore else _c(channel)
    return F.concat_ws("_", ch, _c(sku).cast("string"))


def row_id(day, channel="Channel", sku="SKU", underscore: bool = True) -> Column:
    """``yyyyMMdd_Channel_SKU``; ``day`` is the run date (report ids) or the
    report date (combined history, L16)."""
    return F.concat_ws("_", date_key(day), sku_channel_id(channel, sku, underscore))
