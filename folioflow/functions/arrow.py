"""Arrow-batched Column functions from functions of strings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value evaluated once however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def if_(value: Column, test: Callable[[Column], Column]) -> Column:
    """A generator of value where test(value) holds, to select: rows where it doesn't go.

    A filter would move below the projections that make value, and make it anew for each mention."""
    return F.explode(F.filter(F.array(value), test))


def column(f: Callable, kind: str) -> Callable[..., Column]:
    """A Column function that applies f to each row of an Arrow batch; a null argument gives null.

    Marked as if its results could differ, so that Catalyst never merges the
    projection that makes a column of it into those that read the column: each
    reference would then call Python again."""

    def guarded(*values):
        return None if any(v is None for v in values) else f(*values)

    @lru_cache(1)
    def made():
        return F.udf(guarded, kind, useArrow=True).asNondeterministic()

    return lambda *columns: made()(*columns)


# Rows and bytes of binary values from which a frame is full.
FRAME_ROWS, FRAME_BYTES = 4096, 8 << 20


def frames(documents: Iterable[list[dict]], columns: list[str], kinds: dict[str, str]) -> Iterator[pd.DataFrame]:
    """The rows of documents as frames with columns of those kinds; a frame holds many small documents, as each costs more than its rows."""

    def made(rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in columns}).astype(kinds)

    rows, held = [], 0
    for found in documents:
        rows += found
        held += sum(len(v) for r in found for v in r.values() if isinstance(v, (bytes, bytearray)))
        if len(rows) >= FRAME_ROWS or held >= FRAME_BYTES:
            yield made(rows)
            rows, held = [], 0
    if rows:
        yield made(rows)


def spread(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """df dealt by key to as many tasks as a shuffle has, and not fewer for few bytes: its rows are small, what Python does with each is not."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
