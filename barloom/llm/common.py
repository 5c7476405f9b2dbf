"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, LongType, StructField, StructType

from barloom.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder of the shared storage and read back.

    Cuts the lineage, so that what follows neither repeats the work nor depends on executors
    that may be lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def give_back() -> None:
    """Returns memory that the allocators of Arrow and C keep after use. A driver that fitted a model
    or fetched a table would else hold it as long as it lives."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's only
    if trim:
        trim(0)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def fresh_name(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that clash with no column of ``df``, ignoring case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def row_order(id_col: Column, row: Column) -> Column:
    """The order of rows by id, nulls last, then by row number, as one number that a hash
    aggregate can hold. Row numbers are below 10^18."""
    past = F.lit(str(2**63)).cast("decimal(20,0)")
    shifted = (F.coalesce(id_col.cast("decimal(20,0)"), past) + past).cast("decimal(20,0)")
    return ((shifted * F.lit(10**18).cast("decimal(19,0)")).cast("decimal(38,0)") + row).cast("decimal(38,0)")


DOUBLE, LONG, INT = DoubleType(), LongType(), IntegerType()


def array_of(kind: DataType) -> ArrayType:
    return ArrayType(kind)


def extended(schema: StructType, **fields: DataType) -> StructType:
    return StructType([*schema.fields, *(StructField(name, kind) for name, kind in fields.items())])
