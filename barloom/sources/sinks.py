"""Writers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.schema import CODE, CSV_HEADERS, DATE, SYMBOLS, VALUES

# The columns of the report, besides the symbol.
REPORT_COLUMNS = ("open", "high", "low", "close", "change", "ratio", "trend", "pred", "name")

#: Scheme of folders that tasks can open as files, and files renamed at once by the driver elsewhere.
MOUNTED, RENAMING = "file", 4
#: Fixed value: Spark's name for the partition of rows without a symbol.
NO_CODE = "__HIVE_DEFAULT_PARTITION__"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", buckets: int | None = None) -> None:
    """Parquet history or enriched table.

    A directory per symbol only suits short lists: at millions of symbols it would make
    millions of files. By default the rows are range-partitioned by key and sorted, so row
    group statistics prune on ``code``; ``buckets`` sets the number of files.
    """
    parts = [F.col(CODE), F.col(DATE)]
    out = df.repartitionByRange(buckets, *parts) if buckets else df.repartitionByRange(*parts)
    out.sortWithinPartitions(CODE, DATE).write.mode(mode).parquet(path)


def _price_columns() -> list[Column]:
    return [F.date_format(DATE, "yyyy-MM-dd").alias("Date"), *[F.col(v).alias(h) for v, h in zip(VALUES, CSV_HEADERS[1:])]]


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bars in the form that :func:`barloom.sources.files.read_exported` reads: the headers of price
    files, one directory per symbol, for short symbol lists."""
    named = df.select(CODE, *_price_columns())
    named.repartition(F.col(CODE)).sortWithinPartitions(CODE, "Date").write.mode(mode).partitionBy(CODE).option(
        "header", True
    ).csv(path)


def export_price_files(df: DataFrame, path: str, prefix: str = "stock_") -> None:
    """Bars as one file ``<prefix><code>.csv`` for each symbol, as :func:`barloom.sources.files.read_price_csv`
    reads them; nothing is written for a symbol without bars, and files of an earlier export are replaced.

    Where the folder is mounted, the tasks write the files under their names. Only Spark's
    writer reaches other file systems; it names files itself, so there the driver renames them.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}/_staged"
    folder = spark._jvm.org.apache.hadoop.fs.Path(staged)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == MOUNTED:
        name = F.coalesce(F.when(F.col(CODE) != "", F.col(CODE)), F.lit(NO_CODE)).alias("name")
        lines = df.select(name, F.to_csv(F.struct(*_price_columns())).alias("line"))
        sized = lines.repartition(F.col("name")).sortWithinPartitions("name", "line")  # lines begin with the day
        written = sized.mapInArrow(_price_files(fs.makeQualified(folder.getParent()).toUri().getPath(), prefix), "files long")
        written.agg(F.sum("files")).collect()
    else:
        export_csv(df, staged)
        _rename_staged(spark, fs, path, staged, prefix)
    fs.delete(folder, True)


def _price_files(folder: str, prefix: str):
    """A task's files; a file is complete before it gets its name, so a repeated task does no harm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(f"{folder}/_staged", exist_ok=True)
        part, files = f"{folder}/_staged/{uuid.uuid4().hex}", 0
        name, out = None, None

        def close() -> None:
            if out is not None:
                out.close()
                os.replace(part, f"{folder}/{prefix}{name}.csv")

        for batch in batches:
            runs, at = pc.run_end_encode(batch.column(0)), 0
            for code, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if code != name:
                    close()
                    name, out, files = code, open(part, "w", encoding="utf-8", newline=""), files + 1
                    out.write(",".join(CSV_HEADERS) + "\n")
                out.write("\n".join(batch.column(1).slice(at, end - at).to_pylist()) + "\n")
                at = end
        close()
        yield pa.RecordBatch.from_pydict({"files": [files]})

    return run


def _rename_staged(spark: SparkSession, fs, path: str, staged: str, prefix: str) -> None:
    """Files under ``staged``, a directory for each symbol, get their names: all are listed in one
    call, and a name costs one rename, from several threads."""
    jvm = spark._jvm
    new_path, listed = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.FileUtil.stat2Paths
    as_text, unquoted = jvm.org.apache.commons.lang3.ArrayUtils.toString, jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder, target = new_path(staged), new_path(path)

    def names(paths, within) -> list[str]:
        """What stands below ``within``, in one call. A comma before its whole path parts two names."""
        root = f"{fs.makeQualified(within).toString()}/"
        return as_text(paths)[1:-1].removeprefix(root).split(f",{root}")

    there = set(names(listed(fs.listStatus(target)), target))

    def rename(part: str) -> None:
        quoted = part.split("/")[0][len(CODE) + 1 :]
        name = f"{prefix}{unquoted.unescapePathName(quoted) if '%' in quoted else quoted}.csv"
        to = new_path(f"{path.rstrip('/')}/{name}")
        if name in there:
            fs.delete(to, False)
        if not fs.rename(new_path(folder, part), to):
            raise OSError(f"{part} was not renamed to {name}")

    parts = [n for n in names(listed(fs.listStatus(listed(fs.listStatus(folder)))), folder) if n.startswith(f"{CODE}=")]
    with ThreadPoolExecutor(RENAMING) as threads:
        for _ in threads.map(rename, parts):
            pass


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Bars as a catalog table bucketed by symbol, and the table read back.

    Windows by symbol, groupings by symbol and joins of such tables then need no shuffle; joins on
    symbol and date need ``spark.sql.requireAllClusterKeysForCoPartition`` set to false for that.
    A symbol has few rows, so buckets are even unless symbols are few.
    """
    sized = df.repartition(buckets, F.col(CODE)).sortWithinPartitions(CODE, DATE)
    sized.write.mode("overwrite").option("path", path).bucketBy(buckets, CODE).sortBy(CODE, DATE).saveAsTable(table)
    return df.sparkSession.table(table)


def write_symbols(symbols: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A stock list without header."""
    symbols.select(SYMBOLS.fieldNames()).write.mode(mode).option("header", False).csv(path)


# The report's headers that are not the column's name in title case.
REPORT_HEADERS = {CODE: "Code"}


def report_header(column: str) -> str:
    return REPORT_HEADERS.get(column, column.title() if column in REPORT_COLUMNS else column)


def write_summary(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated report in the order of ``df``; the report's own columns are in title case,
    a screening column keeps its name."""
    named = df.select(*[F.col(c).alias(report_header(c)) for c in df.columns])
    named.write.mode(mode).option("sep", "\t").option("header", True).csv(path)


def append_snapshot(df: DataFrame, path: str, snapshot_date: str) -> None:
    """Dated copy of a report. Writing the same date again replaces that day only."""
    (
        df.withColumn("snapshot_date", F.lit(snapshot_date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )
