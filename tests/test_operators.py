import itertools
import os
import random

import numpy as np
import pytest

from gleanery.functions import pixels
from gleanery.operators import dedup, models, naming, palette, resume
from gleanery.operators.graph import connected_components
from gleanery.plans import pipelines
from gleanery.sinks import apply, files
from gleanery.sources import listing, prior
from gleanery.streaming import incremental


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(1, 2), (3, 4), (2, 1), (5, 5)], [(0, i) for i in range(1, 30)]])
def test_components_equal_union_find(spark, edges):
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == union_find([e for e in edges if e[0] != e[1]])


def test_no_edges_no_components(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("distance", [0, 3, 10])
def test_banded_join_equals_direct(spark, distance):
    random.seed(distance)
    base = [random.getrandbits(64) for _ in range(12)]
    hashes = [h ^ sum(1 << b for b in random.sample(range(64), random.randrange(12))) for h in base for _ in range(5)]
    rows = [(i, h - 2**64 if h >= 2**63 else h) for i, h in enumerate(hashes)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, phash long")
    expected = {(i, j) for i, j in itertools.combinations(range(len(hashes)), 2) if bin(hashes[i] ^ hashes[j]).count("1") <= distance}
    for direct in (10**6, 0):
        assert {(r["u"], r["v"]) for r in dedup.hamming_pairs(df, distance, direct_rows=direct).collect()} == expected


def test_missing_vectors_keep_their_group(spark):
    rows = [(1, 1, [1.0, 0.0]), (2, 1, None), (3, 1, [0.0, 1.0]), (4, 2, [1.0, 0.0]), (5, 2, [0.0, 1.0]), (6, 3, [0.0, 0.0]), (7, 3, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, group_id long, vector array<double>")
    assert {(r["u"], r["v"]) for r in dedup.cosine_pairs_in_groups(df).collect()} == {(1, 2), (2, 3)}


def test_first_wins_and_ranks(spark):
    df = spark.createDataFrame([("b", "k"), ("a", "k"), ("c", "x"), ("d", None), ("e", None)], "path string, key string")
    assert {r["path"]: r["is_duplicate"] for r in dedup.first_wins(df, "key", ["path"]).collect()} == {"a": False, "b": True, "c": False, "d": False, "e": True}
    ranked = dedup.keep_rank(spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 9)], "group_id int, path string, size int"))
    assert [r["path"] for r in ranked.orderBy("rank").collect()] == ["c", "a", "b"]


def test_resume(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "path string")
    done = spark.createDataFrame([("a",), (None,)], "image_path string")
    assert sorted(str(r["path"]) for r in resume.unprocessed(df, done, "path", "image_path").collect()) == ["None", "b", "b"]
    statuses = spark.createDataFrame([("processed",), ("error",), ("error",), (None,)], "status string")
    assert resume.run_counters(statuses).first().asDict() == {"processed": 1, "errors": 2, "duplicates": 0, "skipped": 0}
    assert resume.metrics_report(spark.createDataFrame([], "batch_size int, inference_s double, io_s double")).count() == 0


def test_serials_are_global(spark):
    random.seed(1)
    rows = [(f"/d{i % 3}/f{i}.png", f"f{i}.png", f"/d{i % 3}", float(random.randrange(20))) for i in range(60)]
    rows += [("/d/1_0000001.jpg", "1_0000001.jpg", "/d", 0.0), ("/d/___!ORIGINAL_IMAGE/x.png", "x.png", "/d/___!ORIGINAL_IMAGE", 0.0)]
    plan = naming.serial_rename_plan(spark.createDataFrame(rows, "path string, name string, dir string, ctime double"))
    got = [(r["path"], r["serial"]) for r in plan.orderBy("serial").collect()]
    assert got == [(p, i + 1) for i, (p, *_) in enumerate(sorted(rows[:60], key=lambda r: (r[3], r[0])))]


def test_hash_names_are_stable(spark):
    h = "d" * 32
    rows = [("b.jpg", h), ("a.jpg", h), (f"{h}_duplicate.jpg", h), ("c.JPG", h), ("z.jpg", h)]
    plan = lambda rows: {r["name"]: r["new_name"] for r in naming.hash_rename_plan(spark.createDataFrame([(n, n, k) for n, k in rows], "path string, name string, hash string")).collect()}
    first = plan(rows)
    assert first == {"a.jpg": f"{h}.jpg", f"{h}_duplicate.jpg": f"{h}_duplicate.jpg", "b.jpg": f"{h}_duplicate_1.jpg", "z.jpg": f"{h}_duplicate_2.jpg", "c.JPG": f"{h}.JPG"}
    again = plan([(n, h) for n in first.values()])
    assert all(a == b for a, b in again.items())


def test_backup_names(spark):
    plan = spark.createDataFrame([("a.png", "/b"), ("c.png", "/b"), ("a.png", "/e")], "name string, backup_dir string")
    held = spark.createDataFrame([("/b", "a.png"), ("/b", "a_1.png")], "dir string, name string")
    assert sorted(r["backup_name"] for r in naming.backup_names(plan, held).collect()) == ["a.png", "a_2.png", "c.png"]


def test_scores(spark):
    preds = [("NSFW", 0.2), ("porn", 0.7), ("Safe", 0.4), ("unsafe", 0.5), ("other", 0.9)]
    df = spark.createDataFrame([("a", preds, 1.005, None), ("b", None, None, "broken")], "path string, preds array<struct<label string, score double>>, inference_ms double, error string")
    good, bad = models.prediction_rows(df).orderBy("path").collect()
    assert (good["nsfw_score"], good["safe_score"], good["inference_ms"]) == (0.7, 0.5, round(1.005, 2))
    assert bad["nsfw_score"] is None and bad["error"] == "broken"


@pytest.fixture
def images(tmp_path):
    rng = np.random.default_rng(4)
    red = np.zeros((6, 6, 3), np.uint8)
    red[..., 0] = 200
    red[:2] = 255
    smooth = pixels.resample(rng.uniform(0, 255, (6, 6, 3)), 40, 40).clip(0, 255).astype(np.uint8)
    (tmp_path / "sub" / "___!ORIGINAL_IMAGE").mkdir(parents=True)
    for name, image in {"red.png": red, "sub/copy.PNG": red, "sub/_smooth.png": smooth, "near.png": np.clip(smooth.astype(int) + 2, 0, 255).astype(np.uint8), "sub/___!ORIGINAL_IMAGE/old.png": red}.items():
        (tmp_path / name).write_bytes(pixels.encode_png(image))
    (tmp_path / "broken.png").write_bytes(b"no image")
    (tmp_path / "note.txt").write_text("x")
    (tmp_path / ".jpg").write_bytes(b"")
    return str(tmp_path)


def names(df):
    return sorted(r["name"] for r in df.collect())


def test_scans(spark, images):
    assert names(listing.scan_recursive(spark, images)) == ["_smooth.png", "broken.png", "copy.PNG", "near.png", "old.png", "red.png"]
    assert names(listing.scan_flat(spark, images)) == [".jpg", "broken.png", "near.png", "red.png"]
    assert names(listing.scan_flat_files(spark, images)) == ["broken.png", "near.png", "red.png"]
    assert names(listing.scan_for_serial(spark, images, recursive=True)) == [".jpg", "_smooth.png", "broken.png", "copy.PNG", "near.png", "red.png"]
    assert names(listing.scan_file_any_suffix(spark, f"{images}/note.txt")) == ["note.txt"]
    assert names(listing.scan_file_or_dir(spark, f"{images}/note.txt")) == []
    assert [r["path"] for r in listing.scan_sorted(spark, images).collect()] == sorted(r["path"] for r in listing.scan_recursive(spark, images, listing.CAPTION).collect())
    with pytest.raises(Exception, match="nothing-here"):
        listing.listing(spark, f"{images}/nothing-here").count()
    assert listing.parse_suffixes("jpg, .PNG") == (".jpg", ".png")


def test_binary_and_image_sources(spark, images):
    assert listing.bytes_of(spark, images, listing.EMBED).count() == 4  # names that begin with _ or . are left out
    rows = {os.path.basename(r["path"]): r for r in listing.decoded_images(spark, images).collect()}
    assert rows["broken.png"]["error"]
    assert bytes(rows["red.png"]["data"])[-3:] == bytes([200, 0, 0])


def test_palettes(spark, images):
    rows = {os.path.basename(r["filename"]): r for r in pipelines.palettes(spark, images).collect()}
    assert [(c["hex"], c["percent"]) for c in rows["red.png"]["colors"]] == [("#c80000", 66.67), ("#ffffff", 33.33)]
    assert rows["broken.png"]["error"] and rows["broken.png"]["colors"] is None
    assert len(palette.palettes(listing.read_bytes(listing.listing(spark, images, recursive=False).where("name = 'near.png'").select("path"))).first()["colors"]) <= 20


def test_near_duplicate_images(spark, images):
    os.rename(f"{images}/sub/_smooth.png", f"{images}/smooth.png")
    rows = pipelines.near_duplicates(spark, images, models.ColourBackend).collect()
    assert sorted(r["name"] for r in rows) == ["near.png", "smooth.png"]
    files.html_report(spark.createDataFrame(rows), f"{images}/report.html")
    page = open(f"{images}/report.html", encoding="utf-8").read()
    assert page.count("<figure") == 2 and page.count('class="keep"') == 1


def test_classify_and_resume(spark, images, tmp_path):
    config = pipelines.ClassifyConfig(images, checkpoint=f"{images}/state")
    out = pipelines.classify(spark, config, models.ColourBackend).toPandas().set_index("path")
    kinds = {os.path.basename(p): s for p, s in out["status"].items()}
    assert kinds["broken.png"] == "error" and sorted(kinds.values()).count("duplicate") == 2
    files.append_results(spark.createDataFrame(out.reset_index()[lambda d: d.status == "processed"][["file_hash", "path"]]), config.checkpoint)
    again = pipelines.classify(spark, config, models.ColourBackend)
    assert again.where("status = 'processed'").count() == 0 and again.where("status = 'resumed'").count() == 5
    fresh = pipelines.ClassifyConfig(images, checkpoint=config.checkpoint, resume=False)
    assert pipelines.classify(spark, fresh, models.ColourBackend).where("status = 'processed'").count() == 3


def test_embed_resumes_from_json(spark, images):
    out = f"{images}/embeddings.json"
    first = pipelines.embed(spark, images, models.ColourBackend, out)
    files.json_array(first, out)
    assert prior.read_prior_json(spark, out, prior.EMBEDDINGS).count() == 5
    assert pipelines.embed(spark, images, models.ColourBackend, out).count() == 5
    with open(out, "w", encoding="utf-8") as f:
        f.write('{"not": "an array"}')
    with pytest.raises(prior.PriorResultError):
        prior.read_prior_json(spark, out, prior.EMBEDDINGS)
    with open(out, "w", encoding="utf-8") as f:
        f.write("{broken")
    assert prior.read_prior_json(spark, out, prior.EMBEDDINGS).count() == 0


def test_captions_and_sinks(spark, images):
    rows = pipelines.captions(spark, images, models.ColourBackend, "A <think>hm</think>colour: ", batch_size=4)
    got = {os.path.basename(r["image"]): r for r in rows.collect()}
    assert got["red.png"]["prediction"] == "A colour: da5555" and got["broken.png"]["error"]
    files.text_lines(rows.where("prediction is not null"), "prediction", f"{images}/prompts")
    assert spark.read.text(f"{images}/prompts").count() == 5
    files.json_array(spark.createDataFrame([], "a int"), f"{images}/empty.json")
    assert open(f"{images}/empty.json").read() == "[]"


def test_a_failed_batch_is_error_rows(spark, images):
    class Failing(models.ColourBackend):
        def caption(self, images, prompt):
            raise RuntimeError("out of memory")

    rows = pipelines.captions(spark, images, Failing, "x").collect()
    assert len(rows) == 6 and all(r["error"] for r in rows)


def test_csv_quotes(spark, tmp_path):
    rows = spark.createDataFrame([("a,b", 0.1, 0.2, 1.0, None), ("c", None, None, None, "bad")], "path string, nsfw_score double, safe_score double, inference_ms double, error string")
    files.csv(rows, f"{tmp_path}/out")
    back = spark.read.option("header", True).csv(f"{tmp_path}/out")
    assert {(r["path"], r["status"]) for r in back.collect()} == {("a,b", "ok"), ("c", "error")}


def test_renames_are_planned_then_applied(spark, images):
    plan = pipelines.hash_rename(spark, images)
    assert {s for *_, s in apply.rename(plan)} == {"planned"} and os.path.exists(f"{images}/red.png")
    assert {s for *_, s in apply.rename(plan, confirm=True)} == {"renamed"}
    assert not os.path.exists(f"{images}/red.png")
    assert apply.rename(pipelines.hash_rename(spark, images), confirm=True) == []


def test_conversion_moves_originals(spark, images):
    done = apply.convert_and_move(spark, pipelines.serial_rename(spark, images), confirm=True)
    assert sorted(s == "converted" for *_, s in done) == [False, False, True, True]
    assert os.path.exists(f"{images}/___!ORIGINAL_IMAGE/red.png") and os.path.exists(f"{images}/broken.png")
    assert pipelines.serial_rename(spark, images).count() == 2


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i, body in enumerate(("a", "b", "a")):
        (source / f"{i}.bin").write_text(body)
    run = lambda: incremental.run_available(incremental.new_content(incremental.file_stream(spark, str(source), files_per_batch=1)).select("file_hash"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    read = lambda: spark.read.parquet(f"{tmp_path}/out").count()
    run()
    assert read() == 2
    (source / "3.bin").write_text("b")
    (source / "4.bin").write_text("c")
    run()
    assert read() == 3


def test_command_line_parses():
    from gleanery.__main__ import backend, parser

    assert parser().parse_args(["hash-rename", "/x"]).apply is False
    assert backend("gleanery.operators.models:ColourBackend") is models.ColourBackend


def test_mean_pool(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 4.0])], "k string, v array<double>")
    assert models.mean_pool(df, ["k"], "v").first()["v"] == [2.0, 3.0]
    assert models.batch_size_of(1) == 4 and models.batch_size_of(100) == 32
