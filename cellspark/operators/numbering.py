"""Numbers and running values in sorted order, without a window.

A window without partition columns, or with a key that holds much of the table,
puts all its rows in one task.  Here the rows are range-partitioned by key and
order, each task numbers what it has, and the few rows that describe where one
partition ends and the next begins (two keys and a count per partition) give the
offsets.  So a key may be spread over any number of tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _changes(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """For each row but the first: does any of the columns differ from the row before?"""
    n = batch.num_rows
    out = np.zeros(max(n - 1, 0), bool)
    for c in columns:
        x = batch.column(c)
        a, b = x.slice(0, n - 1), x.slice(1)
        differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        out |= differ | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
    return out


def running(df: DataFrame, keys: list[str], order: list, xors: dict[str, str] | None = None, out_col: str = "number",
            partitions: int | None = None, sums: dict[str, str] | None = None) -> DataFrame:
    """``df`` with ``out_col``: the place (from 1) of each row among the rows of its
    ``keys``, in the order of ``order`` (columns or sort expressions); without keys, among
    all rows.  For every entry of ``xors`` and ``sums`` (new column: column of longs, not
    null) also the exclusive or or the sum of that column up to and including the row.

    Rows that ``keys`` and ``order`` do not tell apart get different numbers in no
    particular order, but each number once.  Null keys are one key.  The result is a
    written table."""
    from ..plans.pipeline import materialize
    spark = df.sparkSession
    sums = sums or {}
    xors = {**(xors or {}), **sums}  # all running values; new columns of ``sums`` are added up
    clash = {out_col, "_part", "_border", "_row", *xors} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    by = [F.col(k) for k in keys] + list(order)
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, *by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())
    added = [T.StructField(out_col, T.LongType()), *(T.StructField(x, T.LongType()) for x in xors),
             T.StructField("_border", T.BooleanType()), T.StructField("_row", T.LongType())]

    def run(batches):
        last, number, seen, border = None, 0, 0, True
        held = dict.fromkeys(xors, np.int64(0))
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            new[1:] = _changes(batch, keys)
            first = batch.slice(0, 1).select(keys).to_pylist()[0]
            new[0] = last is not None and first != last
            at = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # where the row's key begins, -1: before the batch
            place = np.where(at < 0, number + np.arange(n) + 1, np.arange(n) - at + 1)
            out = [*batch.columns, pa.array(place)]
            for x, c in xors.items():
                fold, undo = (np.add, np.subtract) if x in sums else (np.bitwise_xor, np.bitwise_xor)
                total = fold.accumulate(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64))
                value = undo(total, np.where(at <= 0, 0, total[np.maximum(at, 1) - 1]))
                value = np.where(at < 0, fold(value, held[x]), value)
                out.append(pa.array(value))
                held[x] = value[-1]
            out += [pa.array((at < 0) & border), pa.array(seen + np.arange(n))]
            last, number, seen = batch.slice(n - 1, 1).select(keys).to_pylist()[0], int(place[-1]), seen + n
            border = border and not new.any()
            yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names, out_col, *xors, "_border", "_row"])

    rows = materialize(ranged.mapInArrow(run, T.StructType(ranged.schema.fields + added)))
    # a row or two per partition
    ends = rows.groupBy("_part").agg(
        F.min(F.struct("_row", *keys)).alias("first"), F.max(F.struct("_row", out_col, *xors, *keys)).alias("last")).orderBy("_part").collect()
    offsets, carry_key, carry_number, carry_xors = [], None, 0, dict.fromkeys(xors, 0)
    for e in ends:
        first, last = tuple(e["first"][k] for k in keys), tuple(e["last"][k] for k in keys)
        goes_on = first == carry_key
        if goes_on:
            offsets.append((e["_part"], carry_number, *(carry_xors[x] for x in xors)))
        add = goes_on and last == first
        carry_number = e["last"][out_col] + (carry_number if add else 0)
        before = carry_xors if add else dict.fromkeys(xors, 0)
        carry_xors = {x: e["last"][x] + before[x] if x in sums else e["last"][x] ^ before[x] for x in xors}
        carry_key = last
    if not offsets:
        return rows.drop("_part", "_border", "_row")
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_offset", T.LongType()),
                           *(T.StructField(f"_x{i}", T.LongType()) for i in range(len(xors)))])
    moved = rows.join(F.broadcast(spark.createDataFrame(offsets, schema)), "_part", "left")  # a row per partition at most
    shifted = F.col("_border") & F.col("_offset").isNotNull()
    columns = {out_col: F.when(shifted, F.col(out_col) + F.col("_offset")).otherwise(F.col(out_col))}
    for i, x in enumerate(xors):
        moved_value = F.col(x) + F.col(f"_x{i}") if x in sums else F.col(x).bitwiseXOR(F.col(f"_x{i}"))
        columns[x] = F.when(shifted, moved_value).otherwise(F.col(x))
    return moved.withColumns(columns).select(*df.columns, out_col, *xors)


def number_rows(df: DataFrame, order: list, out_col: str = "number") -> DataFrame:
    """``df`` with consecutive numbers from 0 in the order of ``order``."""
    return running(df, [], order, out_col=out_col).withColumn(out_col, F.col(out_col) - 1)
