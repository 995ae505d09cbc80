"""Documents from a stream of raw blocks.

A document's blocks arrive in one batch (the source writes a document at once),
so each micro-batch is the batch plan, and its output is appended whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import export, normalize


def to_markdown(raw_blocks: DataFrame, question_layouts: bool = True) -> DataFrame:
    """(doc_id, markdown) of raw blocks: adapted, with options, exported. Documents with a row in error are left out: they have no row in the result."""
    elements = normalize.adapt(raw_blocks)
    bad = elements.where("error IS NOT NULL").select("doc_id").distinct()
    return export.markdown(normalize.normalize_options(elements.drop("error").join(bad, "doc_id", "left_anti")), question_layouts)


def write_markdown(raw_blocks: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """A running query that appends each batch's documents to target, once: a batch rewrites its own folder."""

    def batch(df: DataFrame, epoch: int) -> None:
        to_markdown(df).write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    return raw_blocks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
