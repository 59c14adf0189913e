"""Small helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.pipeline import materialize, scratch, tidy

__all__ = ["materialize", "scratch", "tidy", "table", "bound_batches", "held_out", "small_side", "sampled"]

#: Bytes of an Arrow batch that is sent to a Python worker.
ARROW_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Have the session cut Arrow batches at ARROW_BYTES.  By default only 10,000 rows or 64 MB
    end a batch, and a worker holds a batch several times over while it works on texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves 1 when divided by 3 (false
    for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: Bytes up to which ``small_side`` broadcasts.
BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, bytes_of=None) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if its size allows one: the rows
    are counted, and ``bytes_of`` (a column, 32 by default) is summed over them.  A
    larger table is joined by a shuffle, with the same result."""
    size = df.agg(F.sum(bytes_of if bytes_of is not None else F.lit(32))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def sampled(docs: DataFrame, ids: DataFrame, id_col: str, bound: int) -> DataFrame:
    """The rows of ``docs`` whose ids are among about ``bound`` of the ``ids``, chosen by
    their hash: the ids are counted, and the hash range that holds so many of them is
    kept.  Only these few ids are sent to the rows, so no text is shuffled."""
    ids = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    n = ids.count()
    share = (1 << 20) if n <= bound else (bound << 20) // n
    few = ids.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < share)
    return docs.join(F.broadcast(few), id_col, "left_semi")  # about ``bound`` ids
