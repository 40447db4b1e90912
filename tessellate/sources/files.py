"""File sources: CSV / parquet / globs, file listings, manifests, change logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions._util import as_list


def read_csv(spark: SparkSession, path, schema=None, header: bool = True,
             infer: bool = False, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV with a header. Prefer an explicit ``schema``: inference costs an
    extra pass over the files."""
    r = spark.read.option("header", header).option("mode", mode)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", infer)
    return r.csv(as_list(path))


def read_parquet(spark: SparkSession, path, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(*as_list(path))


def read_many(spark: SparkSession, root: str, fmt: str = "parquet", glob: str | None = None,
              recursive: bool = True, schema=None, **options) -> DataFrame:
    """Read every file under ``root`` matching ``glob`` as one DataFrame.

    One multi-file scan (listing is parallel, files are split across tasks)
    instead of reading file by file and concatenating.
    """
    r = spark.read.format(fmt).option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(root)


def with_file_info(df: DataFrame) -> DataFrame:
    """Add ``_file_path`` and ``_file_modified`` from the hidden file metadata."""
    return df.select("*", F.col("_metadata.file_path").alias("_file_path"),
                     F.col("_metadata.file_modification_time").alias("_file_modified"))


def list_files(spark: SparkSession, root: str, glob: str | None = None,
               modified_after: str | None = None) -> DataFrame:
    """Listing ``(path, modified, length)`` of files under ``root`` (contents not read).

    ``modified_after`` drops older files at listing time.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    return r.load(root).select("path", F.col("modificationTime").alias("modified"), "length")


def read_manifest_entities(spark: SparkSession, path) -> DataFrame:
    """``model.json``-style manifests -> one row per (manifest file, entity name)."""
    m = spark.read.option("multiLine", True).json(as_list(path))
    return (m.select(F.col("_metadata.file_path").alias("manifest_path"),
                     F.explode("entities").alias("e"))
            .select("manifest_path", F.col("e.name").alias("entity")))


def read_manifests(spark: SparkSession, path) -> DataFrame:
    """``<folder>/model.json`` manifests -> ``folder, entity, attributes`` (array of
    name and dataType), one row per folder and entity."""
    schema = "entities array<struct<name:string,attributes:array<struct<name:string,dataType:string>>>>"
    m = spark.read.schema(schema).option("multiLine", True).json(as_list(path))
    return (m.select(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1).alias("folder"),
                     F.explode("entities").alias("e"))
            .select("folder", F.col("e.name").alias("entity"), F.col("e.attributes").alias("attributes")))


def read_change_log(spark: SparkSession, path) -> DataFrame:
    """Comma-separated folder names in text files -> one row per folder name."""
    t = spark.read.text(as_list(path))
    return (t.select(F.explode(F.split("value", ",")).alias("folder"))
            .select(F.trim("folder").alias("folder")).where(F.col("folder") != ""))
