"""CSV and parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from leadrank.functions.contacts import FIELDS, SLOTS, slot_column


def company_schema(with_contacts: bool = True) -> StructType:
    """Columns of a company table as exported by the lead tools."""
    # Column names of the export.
    columns = [
        ("Company", StringType()),
        ("Starred", BooleanType()),
        ("Name", StringType()),
        ("Description", StringType()),
        ("Annual revenue (Apollo)", DoubleType()),
        ("Employees (Apollo)", DoubleType()),
        ("Has received funding? (Apollo)", BooleanType()),
        ("Linkedin Employees", DoubleType()),
        ("Linkedin Size", StringType()),
    ]
    schema = StructType([StructField(name, kind) for name, kind in columns])
    if with_contacts:
        for slot in SLOTS:
            for field in FIELDS:
                schema = schema.add(slot_column(field, slot), StringType())
    return schema


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with header and multi-line quoted fields, under an explicit schema.

    A multi-line CSV file cannot be split, so a big table should be many files
    or parquet.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV with header; fields keep their outer whitespace and line breaks."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_ranked(df: DataFrame, path: str, rank: str = "rank", fmt: str = "parquet", mode: str = "error") -> None:
    """Store a ranked result. The rank column carries the order, not the files."""
    if rank not in df.columns:
        raise ValueError(f"a ranked result needs a {rank!r} column")
    if fmt == "csv":
        write_csv(df, path, mode)
    elif fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*[F.col(f"`{c}`") for c in columns])
