"""Colour palettes: quantised pixels, counts and shares."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.columns import spare
from gleanery.functions import pixels, text
from gleanery.shipping import ship

COLOURS = 20
COUNTS = "filename string, r int, g int, b int, n long, error string"


def palette_counts(files: DataFrame, colours: int = COLOURS, quantizer=pixels.quantize) -> DataFrame:
    """files: path and content. A row for each colour of each image's palette with its pixels, or one row with an error."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    palette, place = quantizer(pixels.on_white(pixels.decode(bytes(content or b""))), colours)
                except ValueError as e:
                    rows.append((path, None, None, None, None, str(e)))
                    continue
                for k, n in pd.Series(place).value_counts().items():
                    rows.append((path, *map(int, palette[k]), int(n), None))
            out = pd.DataFrame(rows, columns=["filename", "r", "g", "b", "n", "error"])
            yield out.astype({c: "Int32" for c in "rgb"} | {"n": "Int64"})

    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(counted, COUNTS)


def with_share(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """counts with percent, each row's share of its key in two digits; totals are summed up before they are joined."""
    total = spare("_total", counts)
    totals = counts.groupBy(key).agg(F.sum(n).alias(total))
    return counts.join(totals, key).withColumn("percent", text.percent(F.col(n), F.col(total))).drop(total)


def palettes(files: DataFrame, colours: int = COLOURS, quantizer=pixels.quantize) -> DataFrame:
    """filename, colors (rgb, hex and percent, most pixels first) and error, for each file."""
    counts = palette_counts(files, colours, quantizer)
    good = with_share(counts.where("error is null"), "filename")
    colour = F.struct(F.array("r", "g", "b").alias("rgb"), text.rgb_hex(F.col("r"), F.col("g"), F.col("b")).alias("hex"), "percent")
    sorted_ = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), colour.alias("colour"))))
    out = good.groupBy("filename").agg(F.transform(sorted_, lambda x: x["colour"]).alias("colors")).withColumn("error", F.lit(None).cast("string"))
    return out.unionByName(counts.where("error is not null").select("filename", F.lit(None).cast(out.schema["colors"].dataType).alias("colors"), "error"))
