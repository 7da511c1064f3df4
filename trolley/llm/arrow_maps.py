"""Map-only passes over (id, text) columns, in Arrow batches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.session import scratch_dir

Batches = Iterable[pa.RecordBatch]


def narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Just the two columns an operator reads, as ``doc_id`` and ``text``; whatever else the
    table holds, under whatever name, cannot clash with what the operator adds."""
    return docs.select(
        docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text")
    )


def map_batches(
    rows: DataFrame,
    fields: list[T.StructField],
    function: Callable[[Batches], Iterator[pa.RecordBatch]],
) -> DataFrame:
    """``function`` over the Arrow batches of ``rows``; the result starts with ``doc_id``."""
    _importable(rows)
    schema = T.StructType([rows.schema["doc_id"], *fields])
    return rows.mapInArrow(function, schema)


def _importable(rows: DataFrame) -> None:
    """Let the Python workers of a local session import this package wherever it was started
    (on a cluster it comes by ``--py-files`` or is installed)."""
    root = str(Path(__file__).resolve().parents[2])
    environment = rows.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def ready(spark: SparkSession) -> SparkSession:
    """``spark`` with a folder for checkpoints: the one its cluster names, or, where none is named
    (as in tests), one of its own, which ``scratch_dir`` only gives to a local session."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or scratch_dir(spark, "checkpoints"))
    return spark


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def append(
    docs: DataFrame,
    fields: list[T.StructField],
    function: Callable[[Batches], Iterator[pa.RecordBatch]],
    *,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with more columns, row by row: ``function`` sees (doc_id, text) batches and its
    columns of the names of ``fields`` come last, renamed where ``docs`` has such a name."""
    _importable(docs)
    wanted = [field.name for field in fields]
    names = [fresh(docs, name) for name in wanted]
    types = [T.StructField(name, field.dataType) for name, field in zip(names, fields)]

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            view = pa.record_batch([column(batch, doc_id), column(batch, text)], ["doc_id", "text"])
            made = pa.Table.from_batches(list(function([view]))).combine_chunks()
            arrays = [made.column(name).chunk(0) for name in wanted] if batch.num_rows else []
            if batch.num_rows:
                yield pa.record_batch([*batch.columns, *arrays], [*batch.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *types]))


def saved(table: DataFrame, label: str) -> DataFrame:
    """``table`` written below ``spark.checkpoint.dir`` and read back: whoever loses an executor
    later reads it again instead of making it again."""
    path = scratch_dir(table.sparkSession, label)
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def bucketed(table: DataFrame, label: str) -> DataFrame:
    """``saved``, in buckets by ``doc_id``, so that joins by it do not shuffle what is read back. Only the
    files stay: the catalog, which a bucketed table has to pass through, does not keep its name."""
    spark = table.sparkSession
    name = f"trolley_{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = table.write.format("parquet").option("compression", "zstd").option("path", scratch_dir(spark, label))
    writer.bucketBy(buckets, "doc_id").saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def small(batches: Batches, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes, a larger row alone: what Python
    objects an operator makes per batch stays bounded."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(column(batch, "text")), 0)
        filled = np.cumsum(lengths.to_numpy(zero_copy_only=False)) // size
        cuts = np.flatnonzero(np.diff(filled)) + 1
        for first, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(first, end - first)


def texts_of(batch: pa.RecordBatch) -> list[str]:
    """Texts of a batch; null reads as empty."""
    return [value or "" for value in column(batch, "text").to_pylist()]


def sha256_of(text):
    return F.sha2(F.encode(text, "UTF-8"), 256)
