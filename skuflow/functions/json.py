"""JSON columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ITEMS_SCHEMA = "array<struct<dsku:string,qty:string>>"


def parse_items(c, strict: bool = False) -> Column:
    """JSON array of ``{dsku, qty}``; non-string -> empty array.

    ``strict`` raises on malformed input; otherwise it becomes NULL. Quantities stay
    text, so that ``2.0`` and ``"2"`` reach the caller's number parsing.
    """
    col = F.col(c) if isinstance(c, str) else c
    opts = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE"}
    return F.from_json(col, ITEMS_SCHEMA, opts)


def json_field(c, field: str, default=None) -> Column:
    """one top-level field of a JSON object string, with a default."""
    col = F.col(c) if isinstance(c, str) else c
    got = F.get_json_object(col, f"$.{field}")
    return got if default is None else F.coalesce(got, F.lit(default))
