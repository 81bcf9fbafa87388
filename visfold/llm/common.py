"""Shared helpers: Arrow-batched row-local text maps, shared scratch space, column names.

``map_texts`` is the one bridge to Python: a row-local ``mapInArrow`` over
``(doc_id, text)``. Spark cuts the input into batches of bounded rows and
bytes, so a task holds one batch at a time however large its partition is,
there is no shuffle, and a lost executor costs only its own tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir, scratch_path, ship_package


def doc_columns(docs: DataFrame) -> DataFrame:
    """Only (doc_id, text): further columns, whatever their names, play no part."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _mapped(batches: Iterator[pa.RecordBatch], make: Callable, schema: StructType) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(schema)
    rows_of = make()
    for batch in batches:
        ids = batch.column(0)
        columns = rows_of(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [ids, *(c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:]))],
            schema=arrow)


def map_texts(docs: DataFrame, make: Callable, columns: str) -> DataFrame:
    """(doc_id, *columns) per document; ``make()`` runs once per task and returns a function
    from a list of texts (None: null) to one list or array per output column."""
    ship_package(docs.sparkSession)
    schema = StructType.fromDDL(f"doc_id bigint, {columns}")
    return doc_columns(docs).mapInArrow(partial(_mapped, make=make, schema=schema), schema)


def _kept(batches: Iterator[pa.RecordBatch], make: Callable, keep: Callable) -> Iterator[pa.RecordBatch]:
    rows_of = make()
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        yield batch.filter(pa.array([bool(k) for k in keep(rows_of(texts))], pa.bool_()))


def filter_texts(docs: DataFrame, make: Callable, keep: Callable) -> DataFrame:
    """The rows of ``docs``, with all their columns, for which ``keep`` says yes.

    ``make()`` runs once per task, as in ``map_texts``; ``keep`` gets its function's columns for a batch
    and returns one truth value per row. Row-local: whole rows pass through, nothing is joined back.
    """
    ship_package(docs.sparkSession)
    return docs.mapInArrow(partial(_kept, make=make, keep=keep), docs.schema)


def id_crc32(column: str = "doc_id") -> Column:
    """crc32 of the id's decimal text (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with ``checkpoint()`` into the folder named by ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Spark's switch that removes an execution's shuffle files at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written into the shared folder, and remove the shuffle files that the write made.

    For rounds that join a result with itself: the planner knows a table's size from its files, whereas a
    checkpoint keeps the plan's estimate, and products of estimates get twice as many digits every round.
    ``discard`` removes the table once nothing reads it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove the files of tables that ``stored`` wrote."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
