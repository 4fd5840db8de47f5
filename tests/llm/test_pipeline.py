"""The pipeline's stages on a small table, each against what it must do, and what is left without this subpackage."""

import collections
import os
import random
import re
import shutil
import subprocess
import sys

import pytest

from gleanery.llm import ngram_join

corpus_pipeline = pytest.importorskip("corpus_pipeline")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    passage = words(1, 80)
    clean = {i: words(50 + i, 60 + i) for i in range(20)}
    junk = {100 + i: "\n".join(" | ".join(words(200 + 10 * i + k, 12).upper().split()) + " ###" for k in range(6)) for i in range(12)}
    near = {40: clean[5], 41: clean[6] + " more", 42: clean[7].replace("th", "TH", 1)}
    passages = {60 + i: f"{words(400 + i, 70)} {passage} {words(500 + i, 70)}" for i in range(4)}
    secret = {80: clean[9][:200] + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + words(600, 90)}
    texts = clean | junk | near | passages | secret
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()] + [(999, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100), 0) for i in texts if i < 15 or i >= 100], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, texts


def test_stages(spark, tables):
    folder, texts = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        seen.append((name, docs))
    kept, single, cut, clean, packed = (d for _, d in seen)
    assert all(d.columns == COLUMNS for d in (kept, single, cut, clean))
    assert {r["doc_id"] for r in kept.collect()} == {i for i in texts if i < 100}
    components = {r["doc_id"]: r["component_id"] for r in ngram_join.joined(kept).collect()}
    assert {r["doc_id"] for r in single.collect()} == {i for i, c in components.items() if i == c}
    assert not {40, 41} & {r["doc_id"] for r in single.collect()}
    shared = collections.Counter()
    for r in cut.collect():
        w = re.findall(r"\S+", r["text"])
        shared.update({tuple(w[k : k + 50]) for k in range(len(w) - 49)})
        assert r["n_chars"] == len(r["text"])
    assert max(shared.values()) == 1
    final = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert "24be64439e3e49cf46" not in final[80] and "[SECRET]" in final[80]
    assert all(final[i] == texts[i] for i in range(20))
    assert {r["doc_id"] for r in packed.collect()} == set(final)


def test_run_gives_the_last_stage(spark, tables):
    out = corpus_pipeline.run(spark, tables[0])
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count()


def test_the_rest_works_without_this_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    shutil.rmtree(copy / "gleanery" / "llm")
    shutil.rmtree(copy / "tests" / "llm")
    os.unlink(copy / "corpus_pipeline.py")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') and n[2:3].isdigit() for n in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, check=True, env=environment)


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
