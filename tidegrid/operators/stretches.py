"""What a stretch of a series holds, and two stretches one after the other: the algebra of confirmed states.

A stretch has its first sign outside the deadband and when, its last sign and since when, and its last observation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scan import fold

KIND = "struct<first:int,first_at:timestamp,sign:int,since:timestamp,last:timestamp>"


def stretch(first, first_at, sign, since, last) -> Column:
    return F.struct(first.alias("first"), first_at.alias("first_at"), sign.alias("sign"), since.alias("since"), last.alias("last")).cast(KIND)


def then(a: Column, b: Column) -> Column:
    """Both, one after the other.  If the second is one run of the first's last sign, it goes on.  Null is no stretch."""
    goes_on = F.coalesce((b["since"] == b["first_at"]) & (b["first"] == a["sign"]), F.lit(False))
    since = F.when(b["sign"].isNull() | goes_on, a["since"]).otherwise(b["since"])
    return stretch(F.coalesce(a["first"], b["first"]), F.coalesce(a["first_at"], b["first_at"]), F.coalesce(b["sign"], a["sign"]), since, F.coalesce(b["last"], a["last"]))


def in_order(stretches: Column) -> Column:
    return fold(stretches, then, KIND)
