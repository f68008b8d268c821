"""CSV and table readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header. Columns follow the file's order, so a header that differs is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("encoding", encoding)
        .option("escape", '"')
        .csv(path)
    )


def read_text(spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column text and named by the header; only the header line is read first.

    ``multi_line`` allows line breaks inside quotes, at the price of one task per file.
    """
    return (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


# Windows-1252 differs from Latin-1 in the codes 0x80 to 0x9F, of which five are undefined.
_CODES = [code for code in range(0x80, 0xA0) if bytes([code]).decode("cp1252", "ignore")]
_AS_LATIN_1 = bytes(_CODES).decode("latin-1")
_AS_WINDOWS_1252 = bytes(_CODES).decode("cp1252")


# Texts that stand for a missing value in a release.
MISSING = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)


def read_release(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A published release: all text, Windows-1252, with the usual marks of missing values as null.

    Spark offers no such charset, so the file is read as Latin-1 and the codes that differ are put
    right in every column.
    """
    raw = read_text(spark, path, "ISO-8859-1", multi_line)

    def value(name: str) -> Column:
        text = F.translate(F.col(name), _AS_LATIN_1, _AS_WINDOWS_1252)
        return F.when(~F.col(name).isin(*MISSING), text).alias(name)

    return raw.select(*[value(name) for name in raw.columns])


def read_folder(spark: SparkSession, folder: str, tables: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """``{folder}/{name}.csv`` for each table; a path may also be a directory of part files."""
    return {name: read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", schema) for name, schema in tables.items()}


def read_mart(spark: SparkSession, name: str, layer: str = "marts") -> DataFrame:
    return spark.table(f"{layer}.{name}")
