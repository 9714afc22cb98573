"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.session import cut_lineage, ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(id_col, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % n


def text_key(text) -> Column:
    """128-bit identity of a text; null for a null text."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def unit_interval(*cols) -> Column:
    """Uniform double in [0, 1) from a 64-bit hash of ``cols``."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0**-53)


def stored(df: DataFrame) -> DataFrame:
    """Write an intermediate once to the shared checkpoint folder."""
    return cut_lineage(df)


# Rows and bytes that a Python worker gets at once, where texts are handed to it.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows and
    ``BATCH_BYTES`` bytes, as whole texts go in them; a smaller setting of
    rows stays."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """Like ``stored``, but as a Parquet table in the same folder: its size
    is then known to the optimizer, which broadcasts it in a join if it is
    under the session's threshold and shuffles it otherwise."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing will read any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def wrapped(docs: DataFrame, **columns) -> DataFrame:
    """(row, ...): every input row whole in one struct, beside the columns
    an operator works on, so that no name of the input can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[(c if isinstance(c, Column) else F.col(c)).alias(k) for k, c in columns.items()])


def unwrapped(rows: DataFrame, *more) -> DataFrame:
    """The whole input rows again, with further columns."""
    return rows.select("row.*", *more)
