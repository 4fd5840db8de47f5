"""Places over all rows and inside groups of any size, and joins to groups of any size: no task ever holds a whole group.

Defined cases: null keys are one group; rows that tie in the order get different places, in any order; an empty table gives
an empty one; helper columns take names that the input doesn't have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.columns import spare
from gleanery.durable import durable

#: A key is hot if it holds over one in HOT_SHARE rows, so that at most HOT_SHARE keys are hot and may be broadcast.
HOT_SHARE = 4096


def global_serial(df: DataFrame, order: list[str | Column], name: str = "serial") -> DataFrame:
    """df with its place, from 1, in the order over all rows.

    Rows are put in ranges, sorted and kept; the driver sums up the number of rows of each range, and a row's place is that
    of its range plus its own in it. No single task sees all rows.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    at = spare("_at", df)
    placed = durable(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id()))
    part = F.shiftright(at, 33).cast("int")
    sizes = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for p, count in sizes:
        starts.append((p, before))
        before += count
    offsets = F.create_map(*(F.lit(x) for pair in starts for x in pair)) if starts else None
    own = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(name, own + (offsets[part] if starts else F.lit(0)) + 1).drop(at)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Left join of rows to one row for each key, where a key may hold any share of the rows.

    count: the column of groups with the number of rows of its key. Keys with over total / HOT_SHARE rows are HOT_SHARE
    at most; they are broadcast and their rows aren't moved. The others are joined by a shuffle, in which no key is hot.
    """
    hot = F.broadcast(groups.where(F.col(count) * HOT_SHARE > total))
    cold = groups.where(F.col(count) * HOT_SHARE <= total)
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(cold, key, "left"), allowMissingColumns=True)


def rank_within(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "rank") -> DataFrame:
    """df with its place, from 1, among the rows with its keys: its place over all rows less that of the group's first."""
    key, serial, first, size = (spare(x, df) for x in ("_key", "_serial", "_first", "_size"))
    placed = global_serial(df.withColumn(key, F.struct(*keys)), [key, *order], serial)
    groups = placed.groupBy(key).agg(F.min(serial).alias(first), F.count(F.lit(1)).alias(size))
    joined = join_groups(placed, groups, key, size, placed.count())
    return joined.withColumn(name, F.col(serial) - F.col(first) + 1).drop(key, serial, first, size)


def free_numbers(rows: DataFrame, keys: list[str], order: list[str | Column], taken: DataFrame, name: str = "number") -> DataFrame:
    """rows with number: the r-th row of its keys gets the r-th number from 1 that taken (keys and number) doesn't have.

    A taken number with s free ones below it stands before the (s + 1)-th row, so a row's number is its place among both.
    """
    slot, kind = spare("_slot", rows), spare("_kind", rows)
    taken = taken.where("number >= 1")
    if taken.isEmpty():
        return rank_within(rows, keys, order, name)
    free = rank_within(rows, keys, order, slot).withColumn(kind, F.lit(1))
    held = rank_within(taken.select(*keys, "number").distinct(), keys, ["number"], slot)
    held = held.select(*keys, (F.col("number") - F.col(slot) + 1).alias(slot), F.lit(0).alias(kind))
    both = free.unionByName(held, allowMissingColumns=True)
    return rank_within(both, keys, [slot, kind], name).where(F.col(kind) == 1).drop(slot, kind)
