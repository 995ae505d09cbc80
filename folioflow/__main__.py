"""python -m folioflow INPUT OUTPUT --engine-module M: files to bundles.

INPUT is a file or folder in any store that Spark reads; module M registers the
engine that --engine names, and may hold HOOKS (plans.run.Hooks). OUTPUT gets a
folder a document. Without --engine-module, INPUT is Parquet of raw blocks and
OUTPUT/documents Parquet of Markdown. Exit 2: bad settings; 1: some or all
documents failed, and are told."""

from __future__ import annotations

import argparse
import importlib
import os
import sys
from pathlib import Path

from .plans import config
from .plans.progress import Lines


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="folioflow")
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--engine-module")
    parser.add_argument("--no-question-layout", dest="question_layout", action="store_false", default=None)
    parser.add_argument("--debug", action="store_true", default=None)
    for name, kind in (("engine", str), ("backend", str), ("server-url", str), ("profile", str), ("max-concurrency", int), ("layout-threshold", float), ("layout-unclip-ratio", float), ("watermark-mode", str), ("mcq-crop-margin", int), ("table-crop-margin", int)):
        parser.add_argument(f"--{name}", type=kind)
    given = vars(parser.parse_args(args))
    try:
        settings = config.resolve(given, os.environ, Path.cwd())
        if not given["engine_module"] and settings.watermark_mode != "off":
            raise ValueError("watermark_mode needs files, so an engine module")
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    from .plans import run
    from .streaming.documents import to_markdown

    spark = SparkSession.builder.appName("folioflow").getOrCreate()
    try:
        with Lines() as lines:
            if not given["engine_module"]:
                to_markdown(spark.read.parquet(given["input"]), settings.question_layout).write.mode("errorifexists").parquet(f"{given['output']}/documents")
                return 0
            hooks = getattr(importlib.import_module(given["engine_module"]), "HOOKS", run.Hooks())
            told = run.run(spark, given["input"], given["output"], settings, hooks, lines)
            failed = 0
            for row in told.where("error IS NOT NULL").toLocalIterator():
                failed += 1
                print(f"{row['path']}: {row['error']}", file=sys.stderr)
            return int(failed > 0)
    except Exception as e:
        print(f"Extraction failed: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
