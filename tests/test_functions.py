import hashlib
import html
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.functions import hashing, pixels, text, vectors


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_rounding_is_that_of_the_exact_value(spark):
    random.seed(3)
    xs = [2.675, 1.005, 0.125, 2.5, 0.0, 100.0, *(random.randrange(10**6) / 1000 + 0.005 for _ in range(500))]
    out = spark.createDataFrame([(x,) for x in xs], ["x"]).select("x", text.rounded(F.col("x"), 2).alias("y")).collect()
    assert all(r["y"] == round(r["x"], 2) for r in out)


def test_cleaning(spark):
    allowed = re.compile(r"[^\w\s.,:;!?()\-\[\]\'\"«»„“/]")
    raw = ["<think a=1>x\ny</THINK >Hello @you &  «me» \u00a0 …”", "<think> open", "a\u2003b\tc", "", "naïve ½ ²_x—y"]
    got = spark.createDataFrame([(x,) for x in raw], ["t"]).select(text.clean_text(F.col("t")).alias("c")).collect()
    for x, r in zip(raw, got, strict=True):
        plain = re.sub(r"(?is)<think\b[^>]*>.*?</think\s*>", "", x)
        assert r["c"] == re.sub(r"\s+", " ", allowed.sub("", plain)).strip()


@pytest.mark.parametrize(("size", "said"), [(0, "0 B"), (1023, "1023 B"), (1024, "1.0 KB"), (1280, "1.2 KB"), (1024**2, "1.0 MB"), (5 * 1024**3, "5120.0 MB")])
def test_sizes(spark, size, said):
    assert one(spark, text.format_size(F.lit(size))) == said


@pytest.mark.parametrize(("name", "ext"), [("a.JPG", ".JPG"), (".jpg", ""), ("a.tar.gz", ".gz"), ("noext", ""), ("..x.png", ".png"), ("a.", ".")])
def test_suffix_is_that_of_splitext(spark, name, ext):
    import os

    assert os.path.splitext(name)[1] == ext
    assert one(spark, text.suffix(F.lit(name))) == ext
    assert one(spark, text.stem(F.lit(name))) == os.path.splitext(name)[0]


def test_names_and_quotes(spark):
    assert one(spark, text.rgb_hex(F.lit(1), F.lit(255), F.lit(16))) == "#01ff10"
    assert one(spark, text.shell_quote(F.lit("it's"))) == "'it'\\''s'"
    assert one(spark, text.html_escape(F.lit("<a&\"'>"))) == html.escape("<a&\"'>")
    assert one(spark, text.file_uri(F.lit("/a b"))) == "file:///a b"
    assert one(spark, text.file_uri(F.lit("C:\\a"))) == "file:///C:/a"
    assert one(spark, text.serial_name(F.lit(12.9), F.lit(7))) == "12_0000007.jpg"
    assert one(spark, text.serial_name(F.lit(12.9), F.lit(12345678))) == "12_12345678.jpg"
    assert one(spark, text.tokens_per_second(F.lit(10), F.lit(0.0))) == 0.0
    assert one(spark, text.amortised_ms(F.lit(10.0), F.lit(0))) is None


def test_hashes(spark):
    body = b"some bytes"
    assert one(spark, hashing.md5_hex(F.lit(body))) == hashlib.md5(body).hexdigest()
    assert one(spark, hashing.blake2b_128(F.lit(body))) == hashlib.blake2b(body, digest_size=16).hexdigest()
    assert one(spark, hashing.hamming(F.lit(-1), F.lit(0))) == 64


def test_perceptual_hash_is_steady():
    rng = np.random.default_rng(1)
    image = (pixels.resample(rng.uniform(0, 255, (8, 8, 3)), 64, 48)).clip(0, 255).astype(np.uint8)
    near = np.clip(image.astype(int) + rng.integers(-3, 4, image.shape), 0, 255).astype(np.uint8)
    other = rng.integers(0, 256, image.shape).astype(np.uint8)
    apart = lambda a, b: bin((hashing.perceptual_hash(a) ^ hashing.perceptual_hash(b)) & (2**64 - 1)).count("1")
    assert apart(image, image) == 0
    assert apart(image, near) <= 6 < apart(image, other)


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], ["a", "b"])
    first, zero = df.select(vectors.cosine_distance(F.col("a"), F.col("b")).alias("d"), vectors.l2_normalize(F.col("a")).alias("n")).collect()
    assert abs(first["d"] - 0.04) < 1e-12 and first["n"] == [0.6, 0.8]
    assert np.isnan(zero["d"]) and all(map(np.isnan, zero["n"]))
    assert one(spark, vectors.sign_bits(F.array(*(F.lit(-1.0 if i else 1.0) for i in range(64))))) == -(2**63)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.sampled_from([1, 2, 3, 4]), st.integers(0, 2**31))
def test_png_round_trip(height, width, channels, seed):
    image = np.random.default_rng(seed).integers(0, 256, (height, width, channels)).astype(np.uint8)
    assert (pixels.decode(pixels.encode_png(image)) == image).all()


def test_png_filters():
    import struct
    import zlib

    rng = np.random.default_rng(2)
    image = rng.integers(0, 256, (5, 4, 3)).astype(np.int64)
    lines = []
    for y, kind in enumerate((0, 1, 2, 3, 4)):
        row = image[y].reshape(-1)
        up = image[y - 1].reshape(-1) if y else np.zeros(12, np.int64)
        left = np.concatenate([np.zeros(3, np.int64), row[:-3]])
        corner = np.concatenate([np.zeros(3, np.int64), up[:-3]])
        near = np.stack([abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)])
        paeth = np.where((near[0] <= near[1]) & (near[0] <= near[2]), left, np.where(near[1] <= near[2], up, corner))
        guess = (0, left, up, (left + up) // 2, paeth)[kind]
        lines.append(bytes([kind]) + ((row - guess) % 256).astype(np.uint8).tobytes())
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + b"\0\0\0\0"
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 5, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert (pixels.decode(png) == image).all()


def test_undecodable_bytes_say_so():
    for body in (b"", b"not an image", b"\x89PNG\r\n\x1a\nrubbish", b"BM123"):
        with pytest.raises(ValueError):
            pixels.decode(body)


def test_white_and_palette():
    clear = np.array([[[10, 20, 30, 0], [10, 20, 30, 255]]], np.uint8)
    assert pixels.on_white(clear).tolist() == [[[255, 255, 255], [10, 20, 30]]]
    palette, place = pixels.quantize(pixels.on_white(clear))
    assert sorted(map(tuple, palette[place].tolist())) == [(10, 20, 30), (255, 255, 255)]
    noisy = np.random.default_rng(5).integers(0, 256, (30, 30, 3)).astype(np.uint8)
    palette, place = pixels.quantize(noisy, 20)
    assert len(palette) == 20 and set(place) == set(range(20))


def test_bounded_sizes(spark):
    df = spark.createDataFrame([(1000, 10), (10, 1000), (300, 200)], ["w", "h"])
    got = [(r[0], r[1]) for r in df.select(pixels.bounded_side(F.col("w"), F.col("h"), 384), pixels.bounded_side(F.col("h"), F.col("w"), 384)).collect()]
    assert got == [(384, 3), (3, 384), (300, 200)]
    assert pixels.bounded_size(10000, 1, 384) == (int(10000 * (384 / 10000)), 1)
    assert pixels.bounded_size(10000, 1, 0) == (10000, 1)
