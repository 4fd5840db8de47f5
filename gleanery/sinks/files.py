"""Result files.

Tables are written as Parquet or JSON lines by the executors. The single-file forms stream rows through the driver a
partition at a time, never the whole table at once.
"""

from __future__ import annotations

import html
import json
import os
import tempfile
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions import text


def _plain(row) -> dict:
    """A record without the fields that it has no value for."""
    return {k: v for k, v in row.asDict(recursive=True).items() if v is not None}


def _atomically(path: str, parts: Iterable[str]) -> None:
    """Writes beside the path and renames, so a reader finds the old file or the new."""
    folder = os.path.dirname(os.path.abspath(path))
    handle, partial = tempfile.mkstemp(dir=folder, prefix=".gleanery-")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.writelines(parts)
        os.replace(partial, path)
    except BaseException:
        os.unlink(partial)
        raise


def json_array(df: DataFrame, path: str, indent: int = 4, ascii_only: bool = False) -> None:
    """One JSON array; an empty table is an empty array."""

    def parts() -> Iterator[str]:
        n = 0
        for n, row in enumerate(df.toLocalIterator(), 1):
            body = json.dumps(_plain(row), indent=indent, ensure_ascii=ascii_only)
            yield ("[\n" if n == 1 else ",\n") + "\n".join(" " * indent + line for line in body.split("\n"))
        yield "\n]" if n else "[]"

    _atomically(path, parts())


def json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def append_results(df: DataFrame, path: str) -> None:
    """A batch's rows beside those of earlier batches, in time that goes with the batch and not with what is there."""
    df.write.mode("append").parquet(path)


def text_lines(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    """A line for each row; line ends inside become spaces."""
    df.select(F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"[\r\n]+", " ").alias("value")).write.mode(mode).text(path)


def csv(predictions: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """path, nsfw_score, safe_score, status and inference_ms with a header; values are quoted where they need it."""
    status = F.when(F.col("error").isNull(), F.lit("ok")).otherwise(F.lit("error"))
    predictions.select("path", "nsfw_score", "safe_score", status.alias("status"), "inference_ms").write.mode(mode).option("header", True).csv(path)


def stdout_json(df: DataFrame) -> None:
    """The records as an indented array of ASCII on standard output."""
    print(json.dumps([_plain(r) for r in df.toLocalIterator()], indent=4))


PAGE = """<!DOCTYPE html>
<html lang="en"><head><meta charset="utf-8"><title>{title}</title><style>
body {{ font-family: sans-serif; margin: 1.5rem; }}
section {{ border-top: 2px solid #ccc; padding: .5rem 0; display: flex; flex-wrap: wrap; gap: 1rem; }}
section h2 {{ width: 100%; font-size: 1rem; }}
figure {{ margin: 0; padding: .4rem; width: 13rem; overflow-wrap: anywhere; border: 1px solid #ddd; }}
figure.keep {{ border-color: #3a3; background: #efe; }}
img {{ max-width: 12rem; max-height: 12rem; }}
textarea {{ width: 100%; height: 10rem; }}
</style></head><body><h1>{title}</h1><p>{summary}</p>
"""
SCRIPT = """<p><button id="make">Commands for what is ticked</button></p><textarea id="commands" readonly></textarea>
<script>
document.getElementById("make").onclick = () => {
  const quoted = s => "'" + s.split("'").join("'\\\\''") + "'";
  const ticked = [...document.querySelectorAll("input:checked")].map(x => "rm " + quoted(x.value));
  document.getElementById("commands").value = ["#!/bin/bash", ...ticked].join("\\n") + "\\n";
};
</script></body></html>
"""


def html_report(groups: DataFrame, path: str, title: str = "Duplicates") -> None:
    """groups: group_id, rank, path, name, size. A page with each group, its first file marked to keep, and a maker of rm commands."""
    rows = groups.select("group_id", "rank", "path", "name", text.format_size(F.col("size")).alias("size"), text.file_uri(F.col("path")).alias("uri")).orderBy("group_id", "rank")
    n_groups = groups.select("group_id").distinct().count()

    def parts() -> Iterator[str]:
        yield PAGE.format(title=html.escape(title), summary=f"Groups: {n_groups}")
        group, n = None, 0
        for r in rows.toLocalIterator():
            if r["group_id"] != group:
                n += 1
                yield ("</section>" if group is not None else "") + f"<section><h2>Group {n}</h2>\n"
                group = r["group_id"]
            keep = ' class="keep"' if r["rank"] == 0 else ""
            yield (
                f'<figure{keep}><img src="{html.escape(r["uri"])}" alt=""><div>{r["size"]}</div>'
                f'<label><input type="checkbox" value="{html.escape(r["path"])}"> {html.escape(r["name"])}</label></figure>\n'
            )
        yield ("</section>" if group is not None else "") + SCRIPT

    _atomically(path, parts())


def palette_page(record: dict, path: str) -> None:
    """A page with the swatches and bars of one palette record, as sinks.files.json_array writes it."""
    if not isinstance(record, dict) or not record.get("colors"):
        raise ValueError("not a palette record")
    bars = "".join(
        f'<div style="display:flex;gap:.5rem;margin:.2rem 0"><code>{html.escape(c["hex"])}</code><div style="flex:1;background:#eee"><div style="width:{float(c["percent"])}%;background:{html.escape(c["hex"])}">&nbsp;</div></div><span>{float(c["percent"])}%</span></div>'
        for c in record["colors"]
    )
    uri = html.escape("file://" + record["filename"])
    _atomically(path, [PAGE.format(title=html.escape(record["filename"]), summary=f'<img src="{uri}" alt="">'), bars, "</body></html>\n"])
