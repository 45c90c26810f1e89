"""Written intermediate tables and files in the folder that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from docpipe.session import shared_folder, ship


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a folder of its own for each call, below the shared folder; not yet made."""
    ship(spark)
    root = shared_folder(spark).rstrip("/")
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}"
    return f"{root}/docpipe/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again. The table cuts the lineage: a lost executor
    costs the reading of some files, not the work that led to them."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
