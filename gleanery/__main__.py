"""The command line: python -m gleanery <program> ..."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from gleanery.operators.models import ColourBackend
from gleanery.plans import pipelines
from gleanery.sinks import apply, files


def backend(name: str | None):
    """module:attribute of a backend's maker; without one, the deterministic stand-in."""
    if not name:
        return ColourBackend
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gleanery")
    programs = top.add_subparsers(dest="program", required=True)

    def program(name: str, *arguments) -> argparse.ArgumentParser:
        out = programs.add_parser(name)
        for flags, how in arguments:
            out.add_argument(*flags, **how)
        return out

    a = lambda *flags, **how: (flags, how)
    model = a("--backend", help="module:maker of the model backend")
    program("embed", a("--input_dir", required=True), a("--output", default="embeddings.json"), a("--resize", type=int, default=384), model)
    program("near-duplicates", a("directory", nargs="?", default="."), a("--hash-distance", type=int, default=10), a("--cosine-distance", type=float, default=0.3), a("--report", default="duplicates.html"), model)
    program("classify", a("path"), a("-b", "--batch-size", type=int, default=16), a("--max-resolution", type=int, default=1024), a("--format", choices=("json", "jsonl", "csv"), default="json"), a("-o", "--output", default="predictions"), a("--checkpoint"), a("--no-resume", action="store_true"), a("--no-dedup", action="store_true"), model)
    program("caption", a("directory"), a("--output", default="captions.json"), a("--text", default="prompt.txt"), a("--prompt", default="Describe the image."), a("--extensions"), a("--batch-size", type=int, default=1), a("--lowercase", action="store_true"), model)
    program("palette", a("path"))
    program("serial-rename", a("path"), a("-r", "--recursive", action="store_true"), a("--apply", action="store_true"))
    program("hash-rename", a("directory"), a("--apply", action="store_true"))
    return top


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("gleanery").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.program == "embed":
        files.json_array(pipelines.embed(spark, args.input_dir, backend(args.backend), args.output, args.resize), args.output)
    elif args.program == "near-duplicates":
        files.html_report(pipelines.near_duplicates(spark, args.directory, backend(args.backend), args.hash_distance, args.cosine_distance), args.report)
    elif args.program == "classify":
        config = pipelines.ClassifyConfig(args.path, args.checkpoint, not args.no_resume, not args.no_dedup, args.batch_size, args.max_resolution)
        out = pipelines.durable(pipelines.classify(spark, config, backend(args.backend)))
        {"json": files.json_array, "jsonl": files.json_lines, "csv": files.csv}[args.format](out.drop("file_hash") if args.format != "csv" else out, args.output)
        if args.checkpoint:
            files.append_results(out.where("status = 'processed'").select("file_hash", "path"), args.checkpoint)
    elif args.program == "caption":
        out = pipelines.durable(pipelines.captions(spark, args.directory, backend(args.backend), args.prompt, args.output, args.extensions, args.batch_size, args.lowercase))
        files.json_array(out, args.output)
        files.text_lines(out.where("prediction is not null"), "prediction", args.text)
    elif args.program == "palette":
        files.stdout_json(pipelines.palettes(spark, args.path))
    elif args.program == "serial-rename":
        for row in apply.convert_and_move(spark, pipelines.serial_rename(spark, args.path, args.recursive), args.apply):
            print(*row, sep="\t")
    else:
        for row in apply.rename(pipelines.hash_rename(spark, args.directory), args.apply):
            print(*row, sep="\t")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
