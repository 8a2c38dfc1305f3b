"""Result tables in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a result back. A missing file gives no rows."""
    try:
        return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, UTF-8. Blank texts come back as null."""
    df.write.option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, non-ASCII kept; missing values are left out."""
    df.write.json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """S10, S12."""
    df.write.parquet(path)


WRITERS = {"csv": write_csv, "json": write_json, "parquet": write_parquet}


READERS = {
    "csv": lambda spark, path, schema: read_csv(spark, path, schema),
    "json": lambda spark, path, schema: spark.read.schema(schema).json(path),
    "parquet": lambda spark, path, schema: spark.read.schema(schema).parquet(path),
}


def write_if_any(df: DataFrame, path: str, form: str = "csv") -> bool:
    """Write only if there are rows.

    The rows are computed and written once, to their target. If it turns out to have none, it is removed again.
    """
    spark = df.sparkSession
    WRITERS[form](df, path)
    if not READERS[form](spark, path, df.schema).isEmpty():
        return True
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return False


def export_products(products: DataFrame, discards: DataFrame, path: str) -> None:
    """The product table as Parquet and CSV, and the discarded rows beside them.

    Parquet is written first and read back for the CSV, so extraction runs once.
    """
    if write_if_any(products, f"{path}/products.parquet", "parquet"):
        written = products.sparkSession.read.schema(products.schema).parquet(f"{path}/products.parquet")
        write_csv(written, f"{path}/products.csv")
    write_if_any(discards, f"{path}/discards.csv")
