"""Writers: partitioned tables, file exports and dated landing folders."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchlake.catalog import DATASETS, dataset_path
from matchlake.operators.dedupe import keep_one
from matchlake.session import remove_folder, shared_folder
from matchlake.sources.readers import POINTER, VERSIONS, published

#: Of an upsert: whether a row is new; no column of a table may be called so.
ADDED = "_added"


def write_files(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    overwrite: str = "static",
    files: int | None = None,
    **options: str,
) -> None:
    """Write ``df``; ``overwrite="dynamic"`` replaces only the partitions it contains.

    Rows are gathered by partition before the write, so that each folder gets few
    files; the rebalance splits a folder that holds much of the table over several
    tasks, which a plain repartition by the folder's columns would not.
    """
    if files:
        df = df.repartition(files)
    elif partition_by:
        df = df.hint("rebalance", *(F.col(c) for c in partition_by))
    writer = df.write.mode(mode).format(file_format).options(**options)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", overwrite).partitionBy(*partition_by)
    writer.save(path)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and what the one action that writes it will have counted: rows, and non-nulls by column."""
    observation = Observation()
    nonnulls = [F.count(F.col(f"`{c}`")).alias(f"nonnull.{c}") for c in df.columns]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *nonnulls), observation


def publish(df: DataFrame, path: str, **options) -> str:
    """Write ``df`` as the table's next version, which readers see whole or not at all.

    A version is a folder of its own below ``path``; a pointer file that is replaced last,
    by one rename, names the current one. A write that fails leaves the table as it was.
    ``options`` go to ``write_files``. Returns the version's folder.
    """
    folder = f"{path.rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex}"
    write_files(df, folder, **options)
    jvm = df.sparkSession._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{POINTER}")
    written = jvm.org.apache.hadoop.fs.Path(f"{folder}.pointer")
    files = pointer.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    out = files.create(written, True)
    out.write(bytearray(folder.rsplit("/", 1)[1], "ascii"))
    out.close()
    modes = df.sparkSession.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    modes[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), df.sparkSession._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(written), files.makeQualified(pointer), modes)
    return folder


def drop_versions(spark: SparkSession, path: str) -> list[str]:
    """Remove all versions of a published table but the current one; returns the removed folders."""
    current = published(spark, path)
    versions = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{VERSIONS}")
    files = versions.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f.getPath().toString() for f in files.listStatus(versions) if f.getPath().getName() != current.rsplit("/", 1)[1]]
    for folder in old:
        remove_folder(spark, folder)
    return old


def upsert(df: DataFrame, path: str, keys: Sequence[str], latest: str, partition_by: Sequence[str]) -> int:
    """Merge ``df`` into the Parquet table at ``path``; returns how many of its partitions were rewritten.

    Of a key the row with the greatest ``latest`` holds, NULL last; of equal days the new row,
    then the smallest by the other columns. ``keys`` include ``partition_by``, so that a key
    stays in its partition, and only partitions that ``df`` has rows of are read and replaced,
    each as a whole. A lost run leaves some of them old and some new, and running it again
    gives the same table. Columns are those of the table; a missing table is made.
    """
    if missing := set(partition_by) - set(keys):
        raise ValueError(f"partitions {sorted(missing)} are no keys")
    spark = df.sparkSession
    if published(spark, path) != path:
        raise ValueError(f"{path} is a published table; its versions are whole")
    new = intermediate(df, "upsert").withColumn(ADDED, F.lit(True))
    touched = new.select(*partition_by).distinct().collect()  # one for each folder that is replaced
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if touched and folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        # Values and not a join, so that the other folders are not listed for reading.
        same = [reduce(and_, (F.col(c).eqNullSafe(F.lit(v)) for c, v in row.asDict().items())) for row in touched]
        old = spark.read.schema(df.schema).parquet(path).where(reduce(or_, same))
        new = new.unionByName(old.withColumn(ADDED, F.lit(False)))
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in (*keys, latest)]
    kept = keep_one(new, keys, [F.col(latest).desc_nulls_last(), F.col(ADDED).desc(), *rest])
    # The merged rows are stored before the folders that they come from are replaced.
    merged = intermediate(kept.drop(ADDED), "upserted")
    write_files(merged, path, partition_by=partition_by, overwrite="dynamic")
    return len(touched)


def write_dataset(
    df: DataFrame, name: str, base: str, overwrite: str = "static", files: int | None = None
) -> str:
    """Write a dataset of the catalog in its own layout; returns its path.

    ``overwrite="publish"`` makes a Parquet dataset a published table.
    """
    dataset, path = DATASETS[name], dataset_path(base, name)
    file_format = {"parquet": "parquet", "csv": "csv"}.get(dataset.layout, "json")
    options = {"csv": {"header": "true"}, "json": {"ignoreNullFields": "false"}}.get(file_format, {})
    if overwrite == "publish" and file_format == "parquet":
        publish(df, path, partition_by=dataset.partition_by, files=files)
    else:
        mode = "static" if overwrite == "publish" else overwrite
        write_files(df, path, file_format, dataset.partition_by, overwrite=mode, files=files, **options)
    return path


def intermediate(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to an intermediate folder and read again: what several outputs share is computed once."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def land_records(df: DataFrame, path: str, ingest_date: str) -> None:
    """Land one day's raw records as JSON lines, below league, season and day.

    The day is a folder of its own, by which the latest landing wins. Landing a day
    again replaces its records of the leagues and seasons that it lands.
    """
    dated = df.withColumn("ingest_date", F.lit(ingest_date))
    write_files(dated, path, "json", ("league", "season", "ingest_date"), overwrite="dynamic")
