"""Fixed-width text identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Width of each standardised identifier.
ID_LENGTHS = {"region_id": 2, "nation_id": 2, "customer_id": 10, "supplier_id": 10,
              "part_id": 10, "order_id": 12, "line_number": 2, "clerk_id": 10}
# Fixed value: what the source writes before a clerk's number.
CLERK_PREFIX = "Clerk#"


def _digits(column: Column, prefix: str | None) -> Column:
    text = F.trim(column.cast("string"))
    return F.regexp_replace(text, f"^{prefix}", "") if prefix else text


def id_problem(column: Column, length: int, prefix: str | None = None) -> Column:
    """Why an identifier can't be standardised, or null."""
    text = _digits(column, prefix)
    return (F.when(text.isNull() | (text == ""), F.lit("id_null"))
             .when(~text.rlike("^[0-9]+$"), F.lit("id_non_digit"))
             .when(F.length(text) > length, F.lit("id_overflow")))


def standardize_id(column: Column, length: int, prefix: str | None = None) -> Column:
    """Text, trimmed, without its prefix, padded with zeros on the left to
    ``length``; null where ``id_problem`` says why not (padding never cuts)."""
    return F.when(id_problem(column, length, prefix).isNull(),
                  F.lpad(_digits(column, prefix), length, "0"))
