"""Inputs: agency tables, caches, checkpoints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

AGENCY_COLUMNS = ["company_name", "contact_person_last_name", "siren", "siret", "phone_1", "postalcode", "street", "city", "website"]
REQUIRED = ["company_name", "contact_person_last_name", "phone_1", "postalcode", "city", "website"]


class LoaderError(RuntimeError):
    """The agency table is missing or lacks columns."""


def read_agencies(spark: SparkSession, path: str) -> DataFrame:
    """Agencies from CSV, all text, with ``seq`` in input order. Headers are checked without case, but read as they are."""
    if "*" not in path and _kind(spark, path) == "absent":
        raise LoaderError(f"input not found: {path}")
    header = spark.read.text(path).first()
    names = [c.strip().strip('"') for c in (header[0] if header else "").removeprefix("﻿").split(",")]
    missing = [c for c in REQUIRED if c not in {n.lower() for n in names}]
    if missing:
        raise LoaderError(f"columns are missing: {missing}")
    schema = StructType([StructField(n, StringType()) for n in names])
    rows = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").option("multiLine", spans_lines(spark, path)).option("escape", '"').option("enforceSchema", True).csv(path)
    for c in AGENCY_COLUMNS:
        if c not in names:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    return in_file_order(rows, "seq").select("seq", *AGENCY_COLUMNS)


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether a CSV may have fields with line ends in them: a line with an odd number of quotes. Without any, files can be split among tasks."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.option("recursiveFileLookup", True).text(path).where(quotes % 2 == 1).isEmpty()


def in_file_order(rows: DataFrame, out: str) -> DataFrame:
    """Numbers the rows of a file scan: files in the order of their paths, rows in that of their file, whatever partitions read them.

    A row's number is that of its file, then the place where its block of the file
    begins plus its place in the block: a row takes a byte at least, so blocks don't
    meet. The blocks, a row for each split of a file, are all that is joined.
    """
    rows = rows.withColumns({"_path": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id()})
    blocks = rows.groupBy("_path", "_block").agg(F.min("_row").alias("_first"))
    files = blocks.select("_path").distinct().withColumn("_file", F.row_number().over(Window.orderBy("_path")) - 1)  # a row for each file
    seq = F.shiftleft(F.col("_file").cast("long"), 44) + F.col("_block") + F.col("_row") - F.col("_first")
    return rows.join(F.broadcast(blocks.join(files, "_path")), ["_path", "_block"]).withColumn(out, seq).drop("_path", "_block", "_row", "_file", "_first")


def _kind(spark: SparkSession, path: str) -> str:
    """``file``, ``folder`` or ``absent``; a storage error is raised."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return "absent"
    return "folder" if fs.getFileStatus(hadoop).isDirectory() else "file"


def _json_or(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The value of a whole JSON file; nothing if it is absent or isn't such JSON."""
    if _kind(spark, path) == "absent":
        return spark.createDataFrame([], f"x {schema}")
    return spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("x")).where("x is not null")


def read_geocode_cache(spark: SparkSession, path: str) -> DataFrame:
    """``key, value`` of the cache, a JSON file or the folder of JSON lines that ``write_geocode_cache`` makes; an empty value is a known miss."""
    settle(spark, path)
    lines = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("x")) if _kind(spark, path) == "folder" else _json_or(spark, path, "map<string,string>")
    rows = lines.select(F.explode("x").alias("key", "value"))
    return rows.select(F.lower("key").alias("key"), F.coalesce("value", F.lit("")).alias("value"))


def write_geocode_cache(cache: DataFrame, path: str) -> None:
    """Replaces the cache: a JSON object a line, in the order of the keys, each with one key."""
    rows = cache.groupBy(F.lower("key").alias("key")).agg(F.max("value").alias("value")).orderBy("key")
    lines = rows.select(F.to_json(F.create_map("key", F.coalesce("value", F.lit("")))).alias("value"))
    replace_folder(cache.sparkSession, lambda new: lines.write.mode("overwrite").text(new), path)


def _hadoop(spark: SparkSession, path: str):
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def settle(spark: SparkSession, path: str) -> None:
    """Ends a replacement that was broken off, so that ``path`` is whole again.

    A crash can leave the new folder beside nothing (it was written whole, so it takes
    its place), or the old one beside nothing (it goes back). Every reader and writer
    of a folder that is replaced calls this first.
    """
    path = path.rstrip("/")
    fs, make = _hadoop(spark, path)
    if fs.exists(make(path)):
        return
    for left in (f"{path}.new/_SUCCESS", f"{path}.old"):
        if fs.exists(make(left)):
            # another one may settle it at the same time: whoever is first is enough
            if not fs.rename(make(left.removesuffix("/_SUCCESS")), make(path)) and not fs.exists(make(path)):
                raise OSError(f"{left} can't be renamed to {path}")
            return


def replace_folder(spark: SparkSession, write: Callable[[str], None], path: str) -> None:
    """Puts a folder that ``write`` makes in the place of another one.

    The new one is written whole beside it, with Spark's mark of success, and only then
    do two renames put it in place. At every moment one whole version is there under
    its own name, the old one's or the new one's, and ``settle`` finds it; the old
    one is deleted last. The file system has to rename folders as a whole, as HDFS does.
    """
    path = path.rstrip("/")
    settle(spark, path)
    fs, make = _hadoop(spark, path)
    for left in (f"{path}.new", f"{path}.old"):  # the whole version is under its own name now
        fs.delete(make(left), True)
    write(f"{path}.new")
    if not fs.exists(make(f"{path}.new/_SUCCESS")):
        fs.create(make(f"{path}.new/_SUCCESS")).close()
    if fs.exists(make(path)) and not fs.rename(make(path), make(f"{path}.old")):
        raise OSError(f"{path} can't be renamed")
    settle(spark, path)
    fs.delete(make(f"{path}.old"), True)


def read_completed(spark: SparkSession, path: str, but: str = "") -> DataFrame:
    """Completed domains, from a JSON file or from the Parquet folder that ``mark_completed`` appends to, less those in its subfolder ``but``."""
    if _kind(spark, path) == "folder":
        rows = spark.read.schema("domain string").option("recursiveFileLookup", True).parquet(path)
        rows = rows.where(~F.col("_metadata.file_path").contains(f"/{but}/")) if but else rows
        return rows.select(F.lower(F.trim("domain")).alias("domain")).distinct()
    rows = _json_or(spark, path, "struct<completed:array<string>>")
    return rows.select(F.explode("x.completed").alias("d")).select(F.lower(F.trim("d")).alias("domain")).distinct()


def mark_completed(summary: DataFrame, path: str, reset: bool = False) -> None:
    """Adds the summary's domains to the completed ones, sorted."""
    done = summary.select(F.lower(F.trim("domain")).alias("domain")).where("domain <> ''").distinct()
    done.orderBy("domain").write.mode("overwrite" if reset else "append").parquet(path)
