"""Reading and writing layer tables.

A table is a folder ``root/layer/name``.  The format is a parameter: ``parquet`` works
everywhere, ``delta`` needs its jar on the classpath.
"""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwise.schemas import CORRUPT_COLUMN, RAW_LINES, RUN_LOG

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"


@dataclass(frozen=True)
class Lakehouse:
    """Where the layers live and how tables are stored."""

    root: str
    format: str = "parquet"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        """Fails with Spark's path-not-found error when the table is missing."""
        return spark.read.format(self.format).load(self.path(layer, name))

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        mode: str = "overwrite",
        *,
        partition_by: Sequence[str] = (),
        enforce_schema: bool = False,
        metrics: Sequence[Column] = (),
    ) -> dict:
        return write_table(
            df,
            self.path(layer, name),
            mode,
            format=self.format,
            partition_by=partition_by,
            enforce_schema=enforce_schema,
            metrics=metrics,
        )


def read_csv(spark: SparkSession, path: str, schema: str = RAW_LINES) -> DataFrame:
    """CSV lines with a header; no inference pass.

    Values that do not fit the schema are null and the line is kept in
    ``_corrupt_record``; ``source_file`` names the file of each line.
    """
    return (
        spark.read.schema(f"{schema}, {CORRUPT_COLUMN} string")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("escape", '"')
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("source_file"))
    )


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Structured log, one JSON object per line."""
    return spark.read.schema(RUN_LOG).json(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def table_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder; it has to exist."""
    files, place = _file_system(spark, path)
    return files.getContentSummary(place).getLength()


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the ``batch_id=`` folders in a folder; none if it does not exist."""
    files, place = _file_system(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def partitions_with(spark: SparkSession, path: str, keys: Sequence[str], child: str) -> list[str]:
    """The partition folders (``key=value`` for each of ``keys``) of a table that hold a folder ``child``."""
    files, place = _file_system(spark, path)
    folders = [path.rstrip("/")] if files.exists(place) else []
    at = spark._jvm.org.apache.hadoop.fs.Path
    for key in keys:
        inside = [(folder, s.getPath().getName()) for folder in folders for s in files.listStatus(at(folder))]
        folders = [f"{folder}/{name}" for folder, name in inside if name.startswith(f"{key}=")]
    return [folder for folder in folders if files.exists(at(f"{folder}/{child}"))]


def remove(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete folders; missing ones are no error."""
    for path in paths:
        files, place = _file_system(spark, path)
        files.delete(place, True)


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put a fully written table in the place of another; the old one goes last.

    Between the two renames there is no table at ``path``: a reader that starts just then fails and has to try again
    (a format with a log of its own, such as Delta, has no such moment).  If the second rename fails, the old
    table is put back and the new one stays where it was written.
    """
    files, place = _file_system(spark, path)
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, f"{staged}.replaced"))
    if not files.rename(place, old):
        raise OSError(f"could not replace {path}; its successor is {staged}")
    if not files.rename(new, place):
        back = files.rename(old, place)
        raise OSError(f"could not replace {path}; its successor is {staged}" + ("" if back else f", the old table {staged}.replaced"))
    files.delete(old, True)


def existing_schema(spark: SparkSession, path: str, format: str) -> StructType | None:
    return spark.read.format(format).load(path).schema if table_exists(spark, path) else None


def check_schema(df: DataFrame, found: StructType | None) -> None:
    """Refuse rows whose column names or types differ from the stored table."""
    if found is None:
        return
    stored = {f.name: f.dataType for f in found.fields}
    given = {f.name: f.dataType for f in df.schema.fields}
    if stored != given:
        differing = sorted(n for n in stored.keys() | given.keys() if stored.get(n) != given.get(n))
        raise ValueError(f"schema differs from the stored table in: {', '.join(differing)}")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    *,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
    enforce_schema: bool = False,
    metrics: Sequence[Column] = (),
) -> dict:
    """Write in one pass and return its row count (``rows``) and any ``metrics``.

    The counts are observed while the rows are written, so there is no second scan.
    Overwriting replaces the schema unless ``enforce_schema``; appending always checks it.
    A plain file table is replaced only when its successor is complete, so a failed write
    leaves it as it was and a table may be rewritten from itself.
    """
    spark = df.sparkSession
    if partition_by:
        # AQE splits large and merges small partitions, so files get an even size.
        df = df.hint("rebalance", *partition_by)
    if mode == "append" or enforce_schema:
        check_schema(df, existing_schema(spark, path, format))
    replace = mode == "overwrite" and format != "delta" and table_exists(spark, path)
    parent, name = path.rstrip("/").rsplit("/", 1)
    # Readers of the parent folder skip names that start with an underscore.
    target = f"{parent}/_{name}-{uuid.uuid4().hex[:12]}" if replace else path
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.format(format).mode(mode)
    if mode == "overwrite" and not enforce_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target)
    if replace:
        _swap(spark, target, path)
    return seen.get


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)
