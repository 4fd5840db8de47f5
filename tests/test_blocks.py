"""Groups of any size meet block against block, and give what all pairs of their rows give."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.operators import blocks, dedup
from gleanery.operators.graph import connected_components


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "LEAST_ROWS", 16)
    monkeypatch.setattr(blocks, "MANY_BLOCKS", 3)
    monkeypatch.setattr(blocks, "MOST_ROWS", 24)


def least_reached(pairs):
    root = {x: x for p in pairs for x in p}

    def of(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in pairs:
        a, b = sorted((of(u), of(v)))
        root[b] = a
    return {x: of(x) for x in root}


def hashes(n=150, seed=1):
    draw = random.Random(seed)
    base = [draw.getrandbits(64) for _ in range(n // 6)]
    return [(draw.choice(base) ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(9)))) for _ in range(n)]


def hashed(spark, found):
    return spark.createDataFrame([(i, h - 2**64 if h >= 2**63 else h) for i, h in enumerate(found)] + [(999, None)], "id long, phash long")


def vectors_in_groups(seed=2):
    draw = np.random.default_rng(seed)
    rows = [(i, "large", draw.normal(size=6)) for i in range(90)] + [(100 + i, f"small {i // 3}", draw.normal(size=6)) for i in range(30)]
    rows += [(200, "large", np.zeros(6)), (201, "large", np.array([1.0, 2.0])), (202, "large", np.array([1.0, 2.5])), (203, None, np.ones(6)), (204, "small 0", np.full(6, 1e-170)), (205, "small 0", np.full(6, 2e160))]
    return [(i, g, v.tolist()) for i, g, v in rows]


def cosine(a, b):
    size = np.sqrt(sum(x * x for x in a)) * np.sqrt(sum(x * x for x in b))
    with np.errstate(all="ignore"):
        return round(float(1 - np.float64(sum(x * y for x, y in zip(a, b, strict=True))) / size), 12) if len(a) == len(b) and size > 0 else float("nan")


def near_in_groups(rows, most):
    return {(u, v) for (u, g, a), (v, h, b) in itertools.combinations(sorted(rows, key=lambda r: r[0]), 2) if g is not None and g == h and cosine(a, b) <= most}


def test_hash_pairs_of_blocks_are_all_pairs(spark, small_blocks):
    found = hashes()
    expected = {(i, j, d) for i, j in itertools.combinations(range(len(found)), 2) if (d := (found[i] ^ found[j]).bit_count()) <= 12}
    pairs = dedup.hamming_pairs(hashed(spark, found), 12, direct_rows=0)
    assert dict(pairs.dtypes) == {"u": "bigint", "v": "bigint", "distance": "int"}
    got = [tuple(r) for r in pairs.select("u", "v", "distance").collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate explode([[" not in plan  # no table of a row for each of 548 values around each hash


@pytest.mark.parametrize("distance", [3, 8, 12])
def test_hash_components_need_no_pairs(spark, small_blocks, distance):
    found = hashes(seed=distance)
    pairs = [(i, j) for i, j in itertools.combinations(range(len(found)), 2) if (found[i] ^ found[j]).bit_count() <= distance]
    got = {r["node"]: r["component"] for r in dedup.hamming_components(hashed(spark, found), distance).collect()}
    assert got == least_reached(pairs)


def test_vector_pairs_of_blocks_are_all_pairs(spark, small_blocks):
    rows = vectors_in_groups()
    df = spark.createDataFrame(rows, "id long, group_id string, vector array<double>")
    got = [tuple(r) for r in dedup.cosine_pairs_in_groups(df, 0.6).select("u", "v").collect()]
    assert len(got) == len(set(got)) and set(got) == near_in_groups(rows, 0.6)


def test_vector_components_need_no_pairs(spark, small_blocks):
    rows = vectors_in_groups(3)
    whole = [(300 + i, "missing", None if i == 1 else [float(i), 1.0]) for i in range(4)]
    df = spark.createDataFrame(rows + whole, "id long, group_id string, vector array<double>")
    got = {r["node"]: r["component"] for r in dedup.cosine_components(df, 0.4).collect()}
    assert got == least_reached([*near_in_groups(rows, 0.4), (300, 301), (301, 302), (301, 303)])


def test_a_distance_at_the_limit_is_rounded(spark):
    rows = [(1, 1, [1.0, 0.0]), (2, 1, [0.3, float(np.sqrt(1 - 0.09))]), (3, 1, [0.3 - 4e-13, float(np.sqrt(1 - 0.09))]), (4, 1, [0.3 - 4e-11, float(np.sqrt(1 - 0.09))])]
    df = spark.createDataFrame(rows, "id long, group_id long, vector array<double>")
    got = {tuple(r) for r in dedup.cosine_pairs_in_groups(df, 0.7).where("u = 1").select("u", "v").collect()}
    assert got == {(1, 2), (1, 3)}


def test_a_group_of_thousands_is_compared_by_tiles(spark):
    """A candidate group that is a whole table, as beyond the point where hashes percolate: 12 million pairs."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(5000, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, 1, v) for i, v in enumerate(x.tolist())], "id long, group_id long, vector array<float>")
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    assert dedup.cosine_pairs_in_groups(df, 0.2).count() == int(np.triu(unit @ unit.T >= 0.8, 1).sum())


def test_one_component_is_compared_once():
    """Rows that are connected already meet no more: comparisons of a group that is one component grow with its rows, not their square."""
    compared = 0

    class Counting(blocks.Hashes):
        def near(self, rows, others):
            nonlocal compared
            compared += len(rows) * len(others)
            return super().near(rows, others)

    import pyarrow as pa

    x = Counting(pa.chunked_array([np.zeros(20_000, dtype=np.int64)]), 18)
    root = blocks.roots(x, None, np.arange(20_000), 20_000)
    assert not root.any() and compared < 20_000 * 1_000


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(60)], [(9, 2), (3, 4), (2, 9), (5, 5), (4, 9)], [(0, i) for i in range(1, 30)]])
def test_few_edges_need_no_rounds(spark, edges):
    rounds = []

    def kept(df):
        rounds.append(1)
        return df.localCheckpoint()

    df = spark.createDataFrame(edges, "u long, v long")
    expected = least_reached([e for e in edges if e[0] != e[1]])
    got = connected_components(df, kept)
    assert {r["node"]: r["component"] for r in got.collect()} == expected and len(rounds) == 1
    assert dict(got.dtypes) == {"node": "bigint", "component": "bigint"}
    assert {r["node"]: r["component"] for r in connected_components(df, kept, driver_edges=0).collect()} == expected


def test_tasks_grow_with_the_meetings_of_blocks(spark, monkeypatch):
    """A group of many blocks has as many tasks as full meetings, so that no task sorts a share of all of them."""
    monkeypatch.setattr(blocks, "MOST_ROWS", 64)
    monkeypatch.setattr(blocks, "LEAST_ROWS", 64)
    hashes = np.random.default_rng(4).integers(-(2**63), 2**63 - 1, 1_000)
    hashes[500:] = hashes[:500] ^ 5
    rows = spark.createDataFrame([(0, i, h) for i, h in enumerate(hashes.tolist())], "part int, id long, x long")
    found, n_rows, n_met = blocks._in_groups(rows)
    assert (n_rows, n_met) == (1_000, 16_000)
    met = blocks._meeting(found, F.sequence(F.lit(0), F.col("blocks") - 1), n_met)
    assert met.rdd.getNumPartitions() >= 125
    most = met.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most <= 1_000  # 4 tasks have 4,000 rows or more
    got = {(r["u"], r["v"], r["distance"]) for r in blocks.pairs_near(rows, blocks.Hashes, 10).collect()}
    apart = np.bitwise_count(hashes.view(np.uint64)[:, None] ^ hashes.view(np.uint64))
    assert got == {(i, j, int(apart[i, j])) for i, j in zip(*(x.tolist() for x in np.nonzero(apart <= 10)), strict=True) if i < j} and len(got) >= 500
