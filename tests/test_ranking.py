"""Ranks, free numbers and names against brute force, with one key that holds most rows, null keys and clashing columns."""

import os
import random
import subprocess
import sys
from collections import defaultdict

from gleanery.operators import dedup, naming, palette, ranking, resume
from gleanery.sources import listing

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def hot_rows(n=400):
    random.seed(5)
    keys = ["hot" if random.random() < 0.9 else random.choice([None, "a", "b", "c"]) for _ in range(n)]
    return [(i, k, random.randrange(50)) for i, k in enumerate(keys)]


def test_ranks_equal_brute_force(spark):
    rows = hot_rows()
    got = ranking.rank_within(spark.createDataFrame(rows, "_key int, k string, _serial int"), ["k"], ["_serial", "_key"])
    assert got.columns[:3] == ["_key", "k", "_serial"]
    groups = defaultdict(list)
    for i, k, at in sorted(rows, key=lambda r: (r[2], r[0])):
        groups[k].append(i)
    expected = {i: n + 1 for g in groups.values() for n, i in enumerate(g)}
    assert {r["_key"]: r["rank"] for r in got.collect()} == expected


def test_ranks_of_no_rows(spark):
    assert ranking.rank_within(spark.createDataFrame([], "k string, at int"), ["k"], ["at"]).count() == 0


def test_free_numbers_equal_brute_force(spark):
    rows = hot_rows()
    random.seed(6)
    taken = [(k, random.randrange(-2, 300)) for k in ("hot", "a", None, "z") for _ in range(120)]
    got = ranking.free_numbers(spark.createDataFrame(rows, "i int, k string, at int"), ["k"], ["at", "i"], spark.createDataFrame(taken, "k string, number long"))
    held, expected = defaultdict(set), {}
    for k, n in taken:
        held[k].add(n)
    for i, k, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        n = next(x for x in range(1, 10_000) if x not in held[k])
        held[k].add(n)
        expected[i] = n
    assert {r["i"]: r["number"] for r in got.collect()} == expected


def test_backup_names_are_unique(spark):
    plan = [(f"{i:03}", "a.png", "/b") for i in range(90)] + [("x", "a_3.png", "/b"), ("y", "a_3.png", "/b"), ("z", ".jpg", "/b"), ("zz", ".jpg", "/b"), ("n", None, "/b")]
    held = [("/b", "a.png"), ("/b", "a_1.png"), ("/b", "a_1.png"), ("/b", "a_04.png"), ("/c", "a_2.png")]
    df = spark.createDataFrame(plan, "path string, name string, backup_dir string")
    got = {r["path"]: r["backup_name"] for r in naming.backup_names(df, spark.createDataFrame(held, "dir string, name string")).collect()}
    names = [n for n in got.values() if n]
    assert len(got) == len(plan) and len(set(names)) == len(names) and not set(names) & {n for d, n in held if d == "/b"}
    assert (got["000"], got["001"], got["x"], got["y"], got["z"], got["zz"]) == ("a_2.png", "a_4.png", "a_3.png", "a_3_1.png", ".jpg", ".jpg_1")
    alone = {r["path"]: r["backup_name"] for r in naming.backup_names(df.where("path < '002'")).collect()}
    assert alone == {"000": "a.png", "001": "a_1.png"}


def test_hot_keys_and_clashing_columns(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "_key int, k string, _first int").withColumnRenamed("k", "_done")
    first = {}
    for i, k, _ in rows:
        first.setdefault(k, i)
    got = {r["_key"]: r["is_duplicate"] for r in dedup.first_wins(df, "_done", ["_key"]).collect()}
    assert got == {i: first[k] != i for i, k, _ in rows}
    done = spark.createDataFrame([("hot",), (None,)], "_done string")
    seen = resume.mark_seen(df, done, "_done")
    assert seen.columns == ["_key", "_done", "_first", "seen"]
    assert {r["_key"]: r["seen"] for r in seen.collect()} == {i: k == "hot" for i, k, _ in rows}
    assert resume.unprocessed(df, done, "_done").count() == sum(k != "hot" for _, k, _ in rows)
    shares = palette.with_share(spark.createDataFrame([("a", 1, 7), ("a", 3, 7)], "f string, n long, _total int"), "f")
    assert sorted((r["percent"], r["_total"]) for r in shares.collect()) == [(25.0, 7), (75.0, 7)]


def test_bytes_of_a_flat_folder_are_read_by_many_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.png").write_bytes(bytes([i]))
    read = listing.read_bytes(listing.scan_flat(spark, str(tmp_path)))
    assert read.rdd.getNumPartitions() > 1
    assert sorted(bytes(r["content"])[0] for r in read.collect()) == list(range(40))


def test_workers_get_the_package_from_any_folder(tmp_path):
    (tmp_path / "a.png").write_bytes(b"x")
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession, functions as F
from gleanery.functions import hashing
from gleanery.sources import listing
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
files = listing.read_bytes(listing.listing(spark, {str(tmp_path)!r}))
print("GOT", files.select(hashing.blake2b_128(F.col("content")).alias("h")).first()["h"])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "GOT " in out.stdout, out.stderr[-2000:]
