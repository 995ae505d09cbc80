"""The string functions under SQL names."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from . import exams, markup
from .mathtext import cell_markdown, prose, scan, tidy_inline


def register(spark: SparkSession) -> None:
    """Publish the Arrow functions to SQL; each takes one string."""

    def text(f):
        return F.udf(lambda s: None if s is None else f(s), "string", useArrow=True)

    for name, f in {"mask_math": lambda s: scan(s)[0], "visible_prose": prose, "normalize_inline_math": tidy_inline, "render_cell": cell_markdown, "cell_text": exams.cell_text}.items():
        spark.udf.register(name, text(f))
    spark.udf.register("normalize_table", F.udf(lambda s: None if s is None else markup.read_table(s), markup.TABLE, useArrow=True))
    spark.udf.register("question_layout", F.udf(lambda s: None if s is None or (x := exams.exam_table(s)) is None else x.row(), exams.LAYOUT, useArrow=True))
