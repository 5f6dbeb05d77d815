"""Reproducible shuffle into shards by a keyed permutation of row numbers.

Rows are numbered by id (ties by text size and checksum, so equal rows alone are
interchangeable), a Feistel network over a domain of ``rows x columns`` cells permutes the
numbers, and cells past the last row are walked along their cycle until a row number comes
up.  ``permuted mod shards`` is the shard, ``permuted div shards`` the slot: shard counts
differ by one at most, and any row's place can be computed from its number alone.

Null ids come first in the numbering; null texts have size 1 and checksum 0; the texts
themselves never move.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitarium.session import stored

SHARDS = 16
ROUNDS = 6
SEED = 20_261
#: Round function: multiply, add, take modulo this prime (2^31 - 1), so that nothing overflows.
PRIME = 2_147_483_647


def round_keys(seed: int = SEED, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    keys, state = [], seed
    for _ in range(rounds):
        row = []
        for _ in range(3):
            state = (state * 48_271 + 11) % PRIME
            row.append(state + 1)
        keys.append(tuple(row))
    return keys


def domain(n: int) -> tuple[int, int]:
    """Rows and columns of the permuted rectangle: the smallest near-square that holds ``n`` cells."""
    rows = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return rows, max(1, -(-n // rows))


def permute_once(x: Column, n: int, keys: list[tuple[int, int, int]]) -> Column:
    """One pass of the network over the rectangle; a bijection of its cells."""
    rows, columns = domain(n)
    pair = F.struct(F.floor(x / columns).cast("long").alias("l"), (x % columns).alias("r"))
    steps = F.array(*(F.struct(*(F.lit(v).cast("long").alias(f) for f, v in zip("abc", key)),
                               F.lit(i % 2).alias("side")) for i, key in enumerate(keys)))

    def step(acc: Column, key: Column) -> Column:
        def mix(v):
            once = (v % PRIME * key["a"] + key["b"]) % PRIME
            return (once * once % PRIME + once * key["c"]) % PRIME
        left = F.when(key["side"] == 0, (acc["l"] + mix(acc["r"])) % rows).otherwise(acc["l"])
        right = F.when(key["side"] == 1, (acc["r"] + mix(acc["l"])) % columns).otherwise(acc["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(steps, pair, step, lambda acc: acc["l"] * columns + acc["r"])


def permute(x: Column, n: int, seed: int = SEED) -> Column:
    """The place of row ``x`` of ``n``.  A cycle passes at most ``cells - n`` cells outside, so
    that many further steps always suffice; only the few rows that land outside take any."""
    keys = round_keys(seed)
    rows, columns = domain(n)
    outside = rows * columns - n
    once = permute_once(x, n, keys)
    if not outside:
        return once
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(outside)), once,
                       lambda acc, _: F.when(acc < n, acc).otherwise(permute_once(acc, n, keys)))
    return F.when(once < n, once).otherwise(walk)


def numbered(df: DataFrame, order: list[str], number: str) -> tuple[DataFrame, int]:
    """``df`` with gapless global row numbers in ``order``, and how many rows there are.

    A range sort numbers rows within their partition; one row per partition is summed up.
    """
    local = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    local = stored(local, "numbered")
    part = F.shiftright("__at", 33)
    sizes = local.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", "__n", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    total = starts.agg(F.sum("__n")).first()[0] or 0
    inside = F.col("__at").bitwiseAND((1 << 33) - 1)
    out = local.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return out.withColumn(number, F.col("__start") + inside).drop("__part", "__n", "__start", "__at"), total


def shard(df: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = SHARDS,
          seed: int = SEED) -> DataFrame:
    """Per row: id, size, text_crc32, law, shard, slot, grown_shard (null: the law is ``rows``)."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    slim = df.select(F.col(f"`{id_column}`"), (F.octet_length(value) + 1).cast("long").alias("size"),
                     F.crc32(value).alias("text_crc32"))
    rows, n = numbered(slim, [id_column, "size", "text_crc32"], "__row")
    place = permute(F.col("__row"), max(n, 1), seed)
    return rows.withColumn("__place", place).select(
        f"`{id_column}`", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("__place") % shards).cast("int").alias("shard"),
        F.floor(F.col("__place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
