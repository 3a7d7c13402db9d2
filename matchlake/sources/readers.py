"""Readers under declared schemas; partition columns come from the folder names."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from matchlake.catalog import DATASETS, dataset_path
from matchlake.session import shared_folder

LANDED = "ingest_date"
#: Of a published table: the folder of its versions, and the file that names the current one.
VERSIONS, POINTER = "_versions", "_current"
CORRUPT = "_corrupt_record"


def read_json_records(spark: SparkSession, path: str, schema: str | StructType, multi_line: bool = False) -> DataFrame:
    """Rows from JSON lines or one-line JSON arrays of rows; such files can be split.

    ``multi_line`` reads arrays and objects that go over several lines, a file to a task.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def split_json_records(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON lines, and the lines that are no records of the schema: ``value`` and ``file``.

    The columns of the folders' names stay with the rows.
    """
    lines = spark.read.text(path)
    folders = [c for c in lines.columns if c != "value"]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    row = F.from_json("value", f"{schema}, {CORRUPT} string", options).alias("row")
    parsed = lines.select("value", row, *folders, F.col("_metadata.file_path").alias("file"))
    broken = F.col(f"row.{CORRUPT}").isNotNull()
    return parsed.filter(~broken).select("row.*", *folders).drop(CORRUPT), parsed.filter(broken).select("value", "file")


def read_json_documents(spark: SparkSession, path: str, schema: str, files: str = "*.json") -> DataFrame:
    """One JSON object, or an array of them, per file at any folder depth; folder names are not columns."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", files).option("multiLine", True).json(path)


def split_json_documents(spark: SparkSession, path: str, schema: str, files: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """Documents like ``read_json_documents``, and the files that hold none: ``value`` and ``file``.

    A file is rejected whole if it is blank, is no JSON, or one of its values is not of its
    type; files of no bytes and nulls in an array are skipped. Documents keep the path of
    their ``file``. A file is read by one task, as documents that go over lines must be.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", files)
    texts = reader.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    declared = spark.createDataFrame([], schema).schema
    kind = declared.simpleString()
    wrapped, holds = F.concat(F.lit('{"documents":'), "value", F.lit("}")), f"documents array<{kind}>, {CORRUPT} string"
    several = F.from_json(wrapped, holds, options)
    single = F.from_json("value", f"{schema}, {CORRUPT} string", options)
    names = [single[f.name].alias(f.name) for f in declared]
    is_array = F.col("value").rlike(r"^\s*\[")
    found = F.when(is_array, several["documents"]).when(single.isNotNull(), F.array(F.struct(*names)))
    corrupt = F.when(is_array, several[CORRUPT]).otherwise(single[CORRUPT])
    parsed = texts.select("value", "file", found.alias("documents"), corrupt.alias(CORRUPT))
    broken = F.col("documents").isNull() | F.col(CORRUPT).isNotNull()
    documents = parsed.where(~broken).select(F.explode("documents").alias("document"), "file")
    return documents.where("document IS NOT NULL").select("document.*", "file"), parsed.where(broken).select("value", "file")


def read_csv(spark: SparkSession, path: str, schema: str, partitions: int | None = None) -> DataFrame:
    """Delimited rows with a header, gzip by file extension; the header names choose the columns.

    A column the header lacks and a value that is not of its type are NULL. Files whose
    headers differ are an error, as their values would go to each other's columns. A
    gzip file is one task, so ``partitions`` spreads its rows after reading.
    """
    header = spark.read.option("header", True).csv(path)
    text = spark.read.schema(header.schema).option("header", True).option("enforceSchema", False).csv(path)
    present = set(text.columns)
    rows = text.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in spark.createDataFrame([], schema).schema
        )
    )
    return rows.repartition(partitions) if partitions else rows


def split_csv(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of CSV files that each have their own header, and the lines that don't fit it: ``value`` and ``file``.

    A file's header is the first line of its first block, and its names choose the columns,
    in any order. A column that it lacks and a value that is not of its type are NULL. A line
    with more or fewer values than the header is rejected; empty lines are skipped. Values
    must not contain line ends. The number of different headers must be small, as each is one
    expression of the plan; the number of files need not be.
    """
    at, start = F.monotonically_increasing_id(), F.col("_metadata.file_block_start")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), start.alias("start"), at.alias("at"))
    # Both scans are alike, without a filter, so that they number the lines alike.
    first = lines.groupBy("file").agg(F.min(F.when(F.col("start") == 0, F.struct("at", "value"))).alias("first"))
    first = intermediate_rows(first.select("file", F.col("first.at").alias("first"), F.col("first.value").alias("header")))
    headers = [row["header"] for row in first.select("header").distinct().collect()]
    body = lines.join(first, "file").where("(start <> 0 OR at <> first) AND trim(value) <> ''")
    wanted = spark.createDataFrame([], schema).schema
    rows, corrupt = F.lit(None), F.lit(None).cast("string")
    for header in headers:
        names = [name.strip() for name in next(csv.reader([header]))]
        known = T.StructType([T.StructField(f"c{n}", T.StringType()) for n in range(len(names))])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        parsed = F.from_csv("value", f"{', '.join(f'{f.name} string' for f in known)}, {CORRUPT} string", options)
        fields = [
            (parsed[f"c{names.index(f.name)}"] if f.name in names else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in wanted
        ]
        rows = F.when(F.col("header") == header, F.struct(*fields)).otherwise(rows)
        corrupt = F.when(F.col("header") == header, parsed[CORRUPT]).otherwise(corrupt)
    if not headers:
        return spark.createDataFrame([], schema), body.select("value", "file")
    parsed = body.select("value", "file", rows.alias("row"), corrupt.alias(CORRUPT))
    broken = F.col(CORRUPT).isNotNull()
    return parsed.where(~broken).select("row.*"), parsed.where(broken).select("value", "file")


def intermediate_rows(df: DataFrame) -> DataFrame:
    """``df`` written to an intermediate folder and read again."""
    folder = shared_folder(df.sparkSession, "headers")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def published(spark: SparkSession, path: str) -> str:
    """The folder of a published table's current version; ``path`` itself for other tables."""
    pointer = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{POINTER}")
    files = pointer.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(pointer):
        return path
    stream = files.open(pointer)
    try:
        version = bytes(stream.readNBytes(64)).decode("ascii")
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{VERSIONS}/{version}"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with its partition columns; of a published table, its current version."""
    return spark.read.parquet(published(spark, path))


def read_dataset(spark: SparkSession, name: str, base: str) -> DataFrame:
    """A dataset of the catalog; raw JSON also gets the day that its path names, NULL where there is none."""
    dataset, path = DATASETS[name], dataset_path(base, name)
    if dataset.layout == "parquet":
        return read_parquet(spark, path)
    reader = {"records": read_json_records, "documents": read_json_documents, "csv": read_csv}
    df = reader[dataset.layout](spark, path, dataset.schema)
    return df if dataset.layout == "csv" else with_landing(df)


def with_landing(df: DataFrame) -> DataFrame:
    """``df`` as it is read from files, with the last date in each file's path as ``ingest_date``."""
    day = F.regexp_extract("_metadata.file_path", r"^.*(\d{4}-\d{2}-\d{2})", 1)
    return df.withColumn(LANDED, F.when(day != "", day))


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself, or an error when it has no row at all."""
    if df.isEmpty():
        raise FileNotFoundError(f"dataset {name} has no rows")
    return df


def rows_frame(spark: SparkSession, rows: Iterable[Mapping], schema: str) -> DataFrame:
    """A frame of a few rows typed in by the caller, such as pairings to score."""
    return spark.createDataFrame([dict(row) for row in rows], schema)
