"""Reading the given tables, Python over Arrow batches, and tables written to the shared folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stratiform.llm.texts import slices
from stratiform.session import scratch_dir

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder that all executors share, and read back: cuts lineage."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    name = os.path.join(tempfile.mkdtemp(), "stratiform_llm.zip")  # read by the driver, which serves it to all
    with zipfile.ZipFile(name, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(name)
    _shipped.add(context.applicationId)


def in_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def beside(docs: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list]], added: dict[str, str], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with new columns computed from slices of its rows.

    ``make`` runs once in each task and returns the function that computes the new columns of a
    slice, in the order of ``added`` (name to type). Kept columns may have any names but those.
    """
    read = keep if "text" in keep else [*keep, "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for part in slices(batches, "text"):
            yield pa.record_batch([*(part.column(c) for c in keep), *compute(part)], names=[*keep, *added])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"`{c}` {kind}" for c, kind in added.items())])
    return in_arrow(docs.select(*(f"`{c}`" for c in read)), run, schema)
