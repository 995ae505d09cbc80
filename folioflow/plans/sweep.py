"""One input under several settings, each into a folder of its own, and how they compare."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Mapping
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession

from ..operators import qa
from ..sources import sinks
from . import run
from .config import Config

# The settings that the two comparisons vary.
THRESHOLDS = {"0.5": {"layout_threshold": 0.5}, "0.4": {"layout_threshold": 0.4}}
UNCLIPS = {"baseline": {}, "vertical-1.2": {"layout_unclip_vertical": 1.2}}


def sweep(spark: SparkSession, source: Path, target: Path, variants: Mapping[str, Mapping], *, sha256: str, config: Config = Config(), hooks: run.Hooks = run.Hooks(), max_watermarks: int = 0) -> dict:
    """Runs source (a file on the driver's disk) under each variant of config; a report of settings, seconds and failed checks.

    Another file than that of sha256 is refused, and so is a target that exists."""
    if hashlib.sha256(source.read_bytes()).hexdigest() != sha256:
        raise ValueError(f"{source} isn't the file that the comparison is about")
    if target.exists():
        raise ValueError("Choose a new output folder; comparisons are never overwritten")
    target.mkdir(parents=True)
    reports = {}
    for name, changes in variants.items():
        settings, began = replace(config, **changes), time.perf_counter()
        told = run.run(spark, str(source), str(target / name), settings, hooks).first()
        if told is None or told["error"]:
            raise RuntimeError(f"{name}: {told['error'] if told else 'no such file'}")
        seconds = time.perf_counter() - began
        text = Path(told["root_dir"], "document.md").read_text(encoding="utf-8")
        rows = qa.checks(spark.createDataFrame([(0, text)], "doc_id long, markdown string"), max_watermarks).collect()
        reports[name] = {"config": settings.report(), "elapsed_seconds": seconds, "checks": {r["check"]: r["passed"] for r in rows}}
    sinks.write_json(target / "comparison.json", reports)
    return reports
