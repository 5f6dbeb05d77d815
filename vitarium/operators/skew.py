"""Joins and orderings that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that can match nothing are spread over this many hash values.
UNMATCHED_SPREAD = 4096


def order_by(seq: str | Sequence[str]) -> Column:
    """One orderable column for a sequence given as one or several columns."""
    return F.col(seq) if isinstance(seq, str) else F.struct(*seq)


def seq_columns(seq: str | Sequence[str]) -> list[str]:
    return [seq] if isinstance(seq, str) else list(seq)


def lookup_join(left: DataFrame, right: DataFrame, key: str, *, how: str = "left",
                spread_by: Sequence[str] | None = None) -> DataFrame:
    """Equi-join of a large table that may be skewed on ``key`` with a lookup table.

    One plain join: neither side is read or counted beforehand.  Its keys appear in no later
    grouping, so adaptive execution is free to split the partitions of hot keys, however many
    there are, by the sizes it sees after the shuffle, and to broadcast a small lookup.  With ``how="inner"``
    either side could be broadcast, and a table that grows when it is exploded looks small beforehand, so the join
    is a merge join: nothing goes through the driver, and its output stays in as many tasks as the table has.
    NULL and empty keys never match; with ``how="left"`` their rows are kept and dealt out by a
    hash of ``spread_by`` (default: all columns of ``left``), since they alone would all hash alike.
    """
    usable = F.coalesce(F.col(key) != "", F.lit(False))
    right = right.filter(usable)
    if how == "inner":
        return left.filter(usable).join(right.hint("merge"), key, how)
    spread = F.pmod(F.xxhash64(*(spread_by or left.columns)), F.lit(UNMATCHED_SPREAD))
    left = left.withColumn("__part", F.when(usable, F.lit(0)).otherwise(spread).cast("int"))
    right = right.withColumn("__part", F.lit(0))
    return left.join(right, [key, "__part"], how).drop("__part")
