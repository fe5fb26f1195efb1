"""Dates carried in file names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_name(name, prefix: str = "", ext: str = "", case_insensitive: bool = True) -> Column:
    """``<prefix>YYYY-MM-DD<ext>`` -> date; no match or impossible date -> NULL."""
    flags = "(?i)" if case_insensitive else ""
    pattern = f"{flags}^{re.escape(prefix)}(\\d{{4}}-\\d{{2}}-\\d{{2}}){re.escape(ext)}$"
    raw = F.regexp_extract(F.col(name) if isinstance(name, str) else name, pattern, 1)
    return F.try_to_date(F.nullif(raw, F.lit("")), "yyyy-MM-dd")
