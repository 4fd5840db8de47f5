"""Exact and near duplicates: content hashes, hash-distance joins and vector refinement."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.columns import spare
from gleanery.durable import durable
from gleanery.functions.hashing import hamming
from gleanery.functions.vectors import doubles
from gleanery.operators.blocks import Hashes, Vectors, components_near, pairs_near
from gleanery.operators.graph import connected_components
from gleanery.operators.ranking import join_groups, rank_within

#: The default thresholds of the two stages.
HASH_DISTANCE, COSINE_DISTANCE = 10, 0.3
#: Up to so many rows one side of the hash join is broadcast (16 bytes a row).
DIRECT_ROWS = 2_048
#: Bits up to which more rows are joined by bands; from there on, bands give more pairs to check than blocks compare.
BANDED = 7
BANDS, BAND_BITS = 4, 16


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """df with is_duplicate: false for the first row of each key by the order.

    The first row is a pre-aggregated minimum, joined back where the rows are for a hot key, so no task gets all its rows.
    Rows without a key are copies of each other; rows that tie for the first place are all first.
    """
    group, first, size = (spare(x, df) for x in ("_key", "_first", "_size"))
    keyed = df.withColumn(group, F.struct(key))
    lead = keyed.groupBy(group).agg(F.min(F.struct(*order)).alias(first), F.count(F.lit(1)).alias(size))
    joined = join_groups(keyed, lead, group, size, df.count())
    return joined.withColumn("is_duplicate", F.struct(*order) != F.col(first)).drop(group, first, size)


def _band_keys(h: Column, flips: int) -> Column:
    """A struct of band and value for each way to flip up to so many bits in one band of the hash."""
    masks = [sum(1 << b for b in bits) for n in range(flips + 1) for bits in combinations(range(BAND_BITS), n)]
    values = F.array(*map(F.lit, masks))

    def around(band: int) -> Column:
        value = F.shiftrightunsigned(h, band * BAND_BITS).bitwiseAND(F.lit((1 << BAND_BITS) - 1).cast("long")).cast("int")
        return F.transform(values, lambda m: F.struct(F.lit(band).alias("band"), value.bitwiseXOR(m).alias("value")))

    return F.flatten(F.array(*map(around, range(BANDS))))


def hamming_pairs(df: DataFrame, distance: int = HASH_DISTANCE, id_column: str = "id", hash_column: str = "phash", direct_rows: int = DIRECT_ROWS) -> DataFrame:
    """u < v and distance, for all pairs of ids whose 64-bit hashes differ in at most so many bits.

    Few rows (counted): one side is broadcast. Many, at small distances: of BANDS bands one differs in at most distance //
    BANDS bits; both sides list the values around theirs in each band, half the bits each, meet in the middle, and pairs are
    checked. At larger ones, all pairs are compared block against block.
    """
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(hash_column).alias("h")).where("h is not null")
    apart = hamming(F.col("h_u"), F.col("h_v"))
    left, right = (rows.select(F.col("id").alias(s), F.col("h").alias(f"h_{s}")) for s in ("u", "v"))
    if rows.count() <= direct_rows:
        pairs = left.join(F.broadcast(right), (F.col("u") < F.col("v")) & (apart <= distance))
    elif distance <= BANDED:
        flips = distance // BANDS
        keyed = [side.withColumn("key", F.explode(_band_keys(F.col(f"h_{s}"), n))) for side, s, n in ((left, "u", flips - flips // 2), (right, "v", flips // 2))]
        pairs = keyed[0].join(keyed[1], "key").where((F.col("u") < F.col("v")) & (apart <= distance)).drop("key").distinct()
    else:
        return pairs_near(_hashes(df, id_column, hash_column), Hashes, distance).select("u", "v", F.col("distance").cast("int").alias("distance"))
    return pairs.select("u", "v", apart.alias("distance"))


def _hashes(df: DataFrame, id_column: str, hash_column: str) -> DataFrame:
    return df.select(F.lit(0).alias("part"), F.col(id_column).cast("long").alias("id"), F.col(hash_column).alias("x"))


def hamming_components(df: DataFrame, distance: int = HASH_DISTANCE, id_column: str = "id", hash_column: str = "phash") -> DataFrame:
    """node and component, the least id that pairs of hamming_pairs connect it with, of each id that has a pair."""
    if distance <= BANDED:
        return connected_components(hamming_pairs(df, distance, id_column, hash_column).select("u", "v"))
    return components_near(_hashes(df, id_column, hash_column), Hashes, distance)


def groups_of(df: DataFrame, pairs: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows of df that are in a pair, with group_id, the least id of those that pairs connect; lone rows are dropped."""
    return in_components(df, connected_components(pairs.select("u", "v")), id_column)


def in_components(df: DataFrame, found: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows of df that have a component, with group_id, that component."""
    return df.join(found.select(F.col("node").alias(id_column), F.col("component").alias("group_id")), id_column)


def _with_vectors(df: DataFrame, id_column: str, vector: str, group: str) -> tuple[DataFrame, DataFrame]:
    """part, id and x of the rows of groups whose vectors are all there, and part, u and v of a star in each of the others."""
    plain = df.schema[vector].dataType.simpleString() == "array<float>"
    rows = df.select(F.col(group).alias("part"), F.col(id_column).cast("long").alias("id"), (F.col(vector) if plain else doubles(F.col(vector))).alias("x"))
    whole = rows.groupBy("part").agg(F.min(F.when(F.col("x").isNull(), F.col("id"))).alias("centre"), F.count(F.lit(1)).alias("n"))
    whole = join_groups(rows, whole.where("n > 1"), "part", "n", rows.count()).where("n is not null")
    stars = whole.where("centre is not null and id <> centre").select("part", F.least("id", "centre").alias("u"), F.greatest("id", "centre").alias("v"))
    return whole.where("centre is null").select("part", "id", "x"), stars


def cosine_pairs_in_groups(df: DataFrame, distance: float = COSINE_DISTANCE, id_column: str = "id", vector: str = "vector", group: str = "group_id") -> DataFrame:
    """u < v for pairs of a group within the cosine distance, rounded to 12 digits, and group.

    A missing vector leaves its row tied to its whole group, which is then one component: such a group gives one star
    instead of its pairs. A zero vector has no distance and no pair. A group of any size meets block against block.
    """
    full, stars = _with_vectors(df, id_column, vector, group)
    return pairs_near(full, Vectors, distance).select("part", "u", "v").unionByName(stars).withColumnRenamed("part", group)


def cosine_components(df: DataFrame, distance: float = COSINE_DISTANCE, id_column: str = "id", vector: str = "vector", group: str = "group_id") -> DataFrame:
    """node and component, the least id that pairs of cosine_pairs_in_groups connect it with; an id is of one group."""
    full, stars = _with_vectors(df, id_column, vector, group)
    return components_near(full, Vectors, distance, stars.select("u", "v"))


def groups_larger_than_one(df: DataFrame, group: str = "group_id") -> DataFrame:
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return df.join(sizes, group, "left_semi")


def keep_rank(df: DataFrame, group: str = "group_id", size: str = "size", path: str = "path") -> DataFrame:
    """df with rank in its group: largest first, then by path; rank 0 is the one to keep."""
    return rank_within(df, [group], [F.desc(size), path]).withColumn("rank", (F.col("rank") - 1).cast("int"))


def near_duplicate_groups(df: DataFrame, hash_distance: int = HASH_DISTANCE, cosine: float = COSINE_DISTANCE, id_column: str = "id", hash_column: str = "phash", vectors=None, vector: str = "vector") -> DataFrame:
    """Rows of df in groups of near duplicates, with group_id: hash candidates, refined by vectors inside each candidate group.

    vectors(candidates) adds the vector column to the candidates only, so that a model runs on them alone; without it the
    column is already there.
    """
    candidates = in_components(df, hamming_components(df, hash_distance, id_column, hash_column), id_column)
    candidates = durable(vectors(candidates) if vectors else candidates)
    return in_components(candidates.drop("group_id"), cosine_components(candidates, cosine, id_column, vector), id_column)
