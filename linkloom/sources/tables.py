"""Input tables, read with explicit schemas where streams need them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom import schemas


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    """Rows of an input table as they arrive as files; like ``table``, from one file or a folder of files."""
    # Streams list what a pattern finds, whichever of the two it is; a plain path has to be a folder.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def page_source(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages as a batch."""
    return spark.read.schema(schemas.FETCHED).parquet(path)


def page_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Fetched pages as they arrive as files."""
    reader = spark.readStream.schema(schemas.FETCHED)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
