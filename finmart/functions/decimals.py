"""Exact money arithmetic.

All money is DECIMAL; doubles never enter a measure.  Spark rounds decimal
casts HALF_UP, the rule the data model assumes.  Ratios are computed by
decimal division whose operand precision is kept small enough that Spark
retains >= 14 fractional digits before the final cast, so the final value
is rounded once in practice (no visible double rounding).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed types of the data model.
MONEY = DecimalType(12, 2)         # prices, amounts, balances
QTY = DecimalType(10, 2)           # quantities
RATE = DecimalType(5, 4)           # discount / tax rates
INTERMEDIATE = DecimalType(12, 4)  # first rounding step of derived amounts
COST = DecimalType(14, 2)          # supply cost, gross margin
RATIO = DecimalType(7, 6)          # margin rate, shares
INDEX = DecimalType(7, 4)          # concentration index
SUM_MONEY = DecimalType(38, 2)     # published type of every money sum
# Operand type used before dividing two sums: small enough precision that
# the quotient keeps 14 fractional digits.
_SUM_OPERAND = DecimalType(24, 2)
_SHARE_OPERAND = DecimalType(24, 14)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(c, p: int, s: int) -> Column:
    return _col(c).cast(DecimalType(p, s))


def money_round_two_step(expr: Column) -> Column:
    """Cast to scale 4 first, then round to cents: the model's deliberate
    two-step rounding (0.014995 -> 0.0150 -> 0.02)."""
    return F.round(expr.cast(INTERMEDIATE), 2).cast(MONEY)


def guarded_ratio(num, den, out: DecimalType = RATIO, guard: str = "positive") -> Column:
    """num / den cast to ``out``; NULL unless the guard holds.

    guard='positive': only when den > 0 (the model's CASE WHEN den > 0).
    guard='nonzero':  only when den <> 0 (NULLIF semantics).
    """
    num, den = _col(num), _col(den)
    q = (num.cast(_SUM_OPERAND) / den.cast(_SUM_OPERAND)).cast(out)
    cond = den > 0 if guard == "positive" else den != 0
    return F.when(cond, q)


def share(part, total, out: DecimalType | None = RATIO) -> Column:
    """part / total; NULL when total is 0 (no error), otherwise exact-ish.

    With ``out=None`` the share is returned at scale 14, the operand form
    used for ratio-of-shares.
    """
    part, total = _col(part), _col(total)
    q = F.when(total != 0, part.cast(_SUM_OPERAND) / total.cast(_SUM_OPERAND))
    return q.cast(_SHARE_OPERAND) if out is None else q.cast(out)
