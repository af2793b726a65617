"""Reconciling the schema of a batch with that of the table it joins.

A batch may lack columns, bring new ones, or bring a type that differs.  The
policy says what that means:

  ignore  the table's columns stay: new ones are dropped, missing ones are NULL
  append  new columns are added (NULL before), missing ones are NULL
  sync    the batch's columns become the table's: new ones are added, missing
          ones are no longer shown (stored rows keep them)
  fail    any difference is an error, before anything is written

A column whose type grows (integers, decimals, float to double, date to
timestamp) is widened, so that no value changes; a type that is narrower is
read as the table's.  Types that no common one holds are an error under every
policy.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POLICIES = ("ignore", "append", "sync", "fail")
_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = dict(zip(map(str, _INTEGERS), (3, 5, 10, 19)))
_FLOATS = [T.FloatType(), T.DoubleType()]
_DATES = [T.DateType(), T.TimestampNTZType()]


class SchemaChangeError(ValueError):
    """A batch whose schema the policy does not accept."""


@dataclass(frozen=True)
class Change:
    column: str
    change: str           # added, missing, dropped, widened or narrower
    table_type: str | None
    batch_type: str | None

    def as_dict(self) -> dict:
        return asdict(self)


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds the values of both; None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for ladder in (_INTEGERS, _FLOATS, _DATES):
        if a in ladder and b in ladder:
            return ladder[max(ladder.index(a), ladder.index(b))]
    if T.DoubleType() in (a, b) and {str(a), str(b)} & set(map(str, _INTEGERS[:3])):
        return T.DoubleType()  # 53 bits hold every 32-bit integer
    sizes = [(_DIGITS[str(t)], 0) if t in _INTEGERS else (t.precision - t.scale, t.scale)
             if isinstance(t, T.DecimalType) else None for t in (a, b)]
    if None in sizes:
        return None
    whole, scale = (max(s) for s in zip(*sizes))
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def reconcile(table: T.StructType | None, batch: T.StructType, policy: str,
              required: tuple[str, ...] = ()) -> tuple[T.StructType, list[Change]]:
    """The table's schema after the batch, and what differed.  Names are equal
    without regard to case, the table's spelling stays.  ``required`` columns
    may never be missing."""
    if policy not in POLICIES:
        raise ValueError(f"unknown schema policy {policy!r}")
    given = {f.name.lower(): f for f in batch.fields}
    lost = [c for c in required if c.lower() not in given]
    if lost:
        raise SchemaChangeError(f"the batch lacks required columns: {', '.join(lost)}")
    if table is None:
        return T.StructType([T.StructField(f.name, f.dataType) for f in batch.fields]), []
    fields, changes = [], []
    for f in table.fields:
        other = given.pop(f.name.lower(), None)
        if other is None:
            changes.append(Change(f.name, "dropped" if policy == "sync" else "missing",
                                  f.dataType.simpleString(), None))
            if policy != "sync":
                fields.append(T.StructField(f.name, f.dataType))
            continue
        both = wider(f.dataType, other.dataType)
        if both is None:
            raise SchemaChangeError(f"column {f.name}: no type holds both {f.dataType.simpleString()} "
                                    f"and {other.dataType.simpleString()}")
        if other.dataType != f.dataType:
            changes.append(Change(f.name, "widened" if both != f.dataType else "narrower",
                                  f.dataType.simpleString(), other.dataType.simpleString()))
        fields.append(T.StructField(f.name, both))
    for f in batch.fields:
        if f.name.lower() in given:
            changes.append(Change(f.name, "added", None, f.dataType.simpleString()))
            if policy in ("append", "sync"):
                fields.append(T.StructField(f.name, f.dataType))
    if policy == "fail" and changes:
        raise SchemaChangeError("the batch's schema differs: " + "; ".join(
            f"{c.column} {c.change} ({c.table_type} / {c.batch_type})" for c in changes))
    return T.StructType(fields), changes


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``; what it lacks is NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in schema.fields])


def union_conformed(parts: list[DataFrame], schema: T.StructType) -> DataFrame:
    return reduce(DataFrame.unionByName, [conform(p, schema) for p in parts])
