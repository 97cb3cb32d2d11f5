"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of every contract: runs of anything but blank, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def work_folder(spark: SparkSession) -> str:
    """The shared folder for cut lineage: ``spark.checkpoint.dir``; without a cluster, where that
    is unset, one under the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return folder.rstrip("/")


def cut(rows: DataFrame, name: str = "cut") -> DataFrame:
    """Write the rows once to the shared folder and go on from there.

    The files outlive lost executors, and what follows reads them instead of computing again.
    They are removed when the application ends.
    """
    spark = rows.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(place)
    return spark.read.schema(rows.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_hash(column: str) -> Column:
    """A hash of an id that is never null, so that rows without an id can be joined as well."""
    return F.xxhash64(F.col(column))


def keep_rows(docs: DataFrame, chosen: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` whose keys are in ``chosen``, once each; one shuffle of the rows.

    ``keys`` gives the key columns of ``chosen`` as expressions over ``docs``; rows that agree
    in all keys are copies of one row, of which one stays.
    """
    names = list(keys)
    keyed = docs.select("*", *(c.alias(k) for k, c in keys.items()))
    found = keyed.join(chosen.select(*names), names, "left_semi")
    return found.dropDuplicates(names).select(*docs.columns)


def groups(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes add up to ``most``, or one row that is larger."""
    a, held = 0, 0
    for b, size in enumerate(sizes.tolist()):
        if b > a and held + size > most:
            yield a, b
            a, held = b, 0
        held += size
    if a < len(sizes):
        yield a, len(sizes)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same work; at the end of a task the worker, which lives on, gives its memory back."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


#: Rows of an Arrow batch where the session has Spark's default; a batch of texts is held several
#: times, by the JVM and its worker.
BATCH, DEFAULT_BATCH = "2000", "10000"


def scanned(rows: DataFrame, work: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``mapInArrow`` over texts in batches of fewer rows; see ``tidy``."""
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == DEFAULT_BATCH:
        conf.set(name, BATCH)
    return rows.mapInArrow(tidy(work), schema)
