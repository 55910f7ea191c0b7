"""What the operators of this folder share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a batch that are Python objects at a time.
AT_ONCE = 256


def few(rows: pa.Array | pa.RecordBatch) -> Iterator:
    """A batch, some rows at a time: as Python objects, a whole one would take several times its room. One part at least."""
    return (rows.slice(start, AT_ONCE) for start in range(0, max(1, len(rows)), AT_ONCE))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and go on from there.

    The folder is the session's ``spark.checkpoint.dir``. Only a local master without one gets a folder of this machine.
    Spark removes the files once nothing refers to them, if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="convoy-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def held_out(modulus: int, remainder: int, id_col: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of its id as text leaves ``remainder``. False for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def input_bytes(df: DataFrame, column: str) -> tuple[int, int]:
    """Bytes of text in a column and the number of rows."""
    row = df.agg(F.sum(F.octet_length(column)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    return int(row["bytes"] or 0), int(row["n"])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
