"""Model operators behind a small protocol; a backend is built once in each Python worker, and only if a row comes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import pixels, text
from gleanery.shipping import ship

# Parts of labels by which a score counts, the first family before the second.
UNSAFE_LABELS, SAFE_LABELS = ("nsfw", "porn", "sexy", "hentai"), ("safe", "normal")

EMBEDDINGS = "path string, embedding_dim int, embedding array<float>, error string"
PREDICTIONS = "path string, preds array<struct<label string, score double>>, inference_ms double, error string"
CAPTIONS = "image string, prediction string, analysis_time_sec double, tokens_per_sec double, error string"


class Backend(Protocol):
    """What a model must offer; images are height x width x channels of 8 bits."""

    def optimal_batch_size(self) -> int: ...

    def embed(self, images: list[np.ndarray]) -> list[np.ndarray]:
        """A vector for each image, or its token vectors (two axes), which are averaged."""

    def classify(self, images: list[np.ndarray]) -> list[list[tuple[str, float]]]: ...

    def caption(self, images: list[np.ndarray], prompt: str) -> list[tuple[str, int]]:
        """Text and number of tokens of each image."""


class ColourBackend:
    """A deterministic backend without a model: block means as the vector, brightness as the class, mean colour as the caption."""

    def optimal_batch_size(self) -> int:
        return 16

    def embed(self, images):
        return [pixels.resample(pixels.on_white(x).astype(np.float64), 4, 4).reshape(-1) for x in images]

    def classify(self, images):
        light = [float(pixels.on_white(x).mean() / 255) for x in images]
        return [[("normal", x), ("nsfw", 1 - x)] for x in light]

    def caption(self, images, prompt):
        return [(f"{prompt} #{r:02x}{g:02x}{b:02x}", 2) for r, g, b in (np.rint(pixels.on_white(x).reshape(-1, 3).mean(axis=0)).astype(int) for x in images)]


def batch_size_of(memory_gb: float, least: int = 4, most: int = 32) -> int:
    """About two images for each GB of the accelerator."""
    return min(most, max(least, int(memory_gb * 2)))


def _batches(frames: Iterator[pd.DataFrame], make: Callable[[], Backend], size: int | None, most_side: int) -> Iterator[tuple[Backend, list[str], list[np.ndarray], list[tuple[str, str]]]]:
    """Backend, paths and images of each batch, and the paths and errors of what can't be decoded."""
    backend = None
    for frame in frames:
        if not len(frame):
            continue
        backend = backend or make()
        step = size or backend.optimal_batch_size()
        for start in range(0, len(frame), step):
            part = frame.iloc[start : start + step]
            paths, images, failed = [], [], []
            for path, content in zip(part["path"], part["content"], strict=True):
                try:
                    image = pixels.decode(bytes(content or b""))
                except ValueError as e:
                    failed.append((path, str(e)))
                    continue
                width, height = pixels.bounded_size(image.shape[1], image.shape[0], most_side)
                images.append(image if (width, height) == image.shape[1::-1] else pixels.resample(image, width, height))
                paths.append(path)
            yield backend, paths, images, failed


def _mapped(files: DataFrame, schema: str, columns: list[str], *how) -> DataFrame:
    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(lambda frames: _run(frames, columns, *how), schema)


def _run(frames, columns: list[str], make, size, most_side, call: Callable, on_error: str) -> Iterator[pd.DataFrame]:
    import time

    for backend, paths, images, failed in _batches(frames, make, size, most_side):
        rows: list[tuple] = []
        if paths:
            began = time.perf_counter()
            try:
                results = call(backend, images)
            except Exception as e:  # a model may raise anything; the batch becomes error rows
                failed += [(p, str(e)) for p in paths]
            else:
                seconds = time.perf_counter() - began
                rows += [(p, *r, None) for p, r in zip(paths, results(seconds), strict=True)]
        if on_error == "row":
            rows += [(p, *[None] * (len(columns) - 2), e) for p, e in failed]
        yield pd.DataFrame(rows, columns=columns)


def embed(files: DataFrame, make: Callable[[], Backend], size: int | None = None, most_side: int = 384, normalize: bool = False, on_error: str = "drop") -> DataFrame:
    """EMBEDDINGS of files (path, content). normalize gives unit vectors; a zero vector then gives NaN."""

    def results(backend, images):
        vectors = [np.asarray(v, dtype=np.float64) for v in backend.embed(images)]
        vectors = [v.mean(axis=0) if v.ndim == 2 else v for v in vectors]
        if normalize:
            with np.errstate(invalid="ignore", divide="ignore"):
                vectors = [v / np.linalg.norm(v) for v in vectors]
        return lambda seconds: [(len(v), v.astype(np.float32).tolist()) for v in vectors]

    names = ["path", "embedding_dim", "embedding", "error"]
    return _mapped(files, EMBEDDINGS, names, make, size, most_side, results, on_error)


def classify(files: DataFrame, make: Callable[[], Backend], size: int | None = None, most_side: int = 1024, on_error: str = "row") -> DataFrame:
    """PREDICTIONS of files; a batch's time is shared by its valid images."""

    def results(backend, images):
        found = backend.classify(images)
        return lambda seconds: [([{"label": a, "score": float(b)} for a, b in preds], seconds * 1000 / len(images)) for preds in found]

    names = ["path", "preds", "inference_ms", "error"]
    return _mapped(files, PREDICTIONS, names, make, size, most_side, results, on_error)


def caption(files: DataFrame, make: Callable[[], Backend], prompt: str, size: int | None = 1, most_side: int = 0, lowercase: bool = False, on_error: str = "row") -> DataFrame:
    """CAPTIONS of files with cleaned text; time and speed are those of the whole batch."""

    def results(backend, images):
        found = backend.caption(images, prompt)
        tokens = sum(n for _, n in found)
        return lambda seconds: [(t, seconds, round(tokens / seconds, 2) if seconds > 0 else 0.0) for t, _ in found]

    names = ["image", "prediction", "analysis_time_sec", "tokens_per_sec", "error"]
    raw = _mapped(files, CAPTIONS, names, make, size, most_side, results, on_error)
    return raw.withColumn("prediction", text.clean_text(F.col("prediction"), lowercase=lowercase))


def score_fold(preds: Column) -> tuple[Column, Column]:
    """Unsafe and safe score: the highest of the labels of each family. A label of the first family doesn't count for the
    second; "unsafe" holds "safe" and so counts as safe. No label gives 0."""
    has = lambda p, parts: F.greatest(*(F.contains(F.lower(p["label"]), F.lit(x)) for x in parts))
    best = lambda keep: F.greatest(F.lit(0.0), F.coalesce(F.array_max(F.transform(F.filter(preds, keep), lambda p: p["score"])), F.lit(0.0)))
    return best(lambda p: has(p, UNSAFE_LABELS)), best(lambda p: ~has(p, UNSAFE_LABELS) & has(p, SAFE_LABELS))


def prediction_rows(predictions: DataFrame) -> DataFrame:
    """path, nsfw_score, safe_score (4 digits), inference_ms (2) and error; rows with an error have nothing else."""
    unsafe, safe = score_fold(F.col("preds"))
    good = F.col("error").isNull()
    value = lambda x, digits: F.when(good, text.rounded(x, digits))
    return predictions.select("path", value(unsafe, 4).alias("nsfw_score"), value(safe, 4).alias("safe_score"), value(F.col("inference_ms"), 2).alias("inference_ms"), "error")


def mean_pool(tokens: DataFrame, key: list[str], vector: str) -> DataFrame:
    """The mean vector of each key's rows, place by place, and its length."""
    places = tokens.select(*key, F.posexplode(vector).alias("_at", "_x")).groupBy(*key, "_at").agg(F.avg("_x").alias("_x"))
    listed = places.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_at", "_x"))).alias("_all"))
    return listed.select(*key, F.transform("_all", lambda p: p["_x"]).alias(vector))
