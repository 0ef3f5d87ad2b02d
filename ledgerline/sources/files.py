"""CSV sources and sinks (raw loads, seeds, exports).

Reads always use a declared schema and FAILFAST, never inference, so a bad
field stops the load instead of silently becoming NULL.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas

SEED_DIR = os.path.join(os.path.dirname(__file__), "seeds")


#: Tables whose fields may have blanks after the delimiter (header too).
SKIP_BLANKS = {"customers"}
#: Columns a file may lack, with the default of the raw table.
DEFAULTS = {"customers": {"total_orders": 0}}


class MissingColumnsError(ValueError):
    pass


def _file_schema(spark: SparkSession, table: str, path: str) -> T.StructType:
    """The file's own column order, typed by the declaration; names come from the header, so the
    reader need not compare them again."""
    schema = schemas.RAW[table]
    header = [c.strip() for c in spark.read.option("header", True).csv(path).columns]
    defaults = DEFAULTS.get(table, {})
    missing = [f.name for f in schema.fields if f.name not in header and f.name not in defaults]
    if missing:
        raise MissingColumnsError(f"{table}: no column {', '.join(missing)} in {path}")
    by_name = {f.name: f for f in schema.fields}
    return T.StructType([by_name.get(c, T.StructField(c, T.StringType())) for c in header])


def rejected_rows(spark: SparkSession, table: str, path: str) -> DataFrame:
    """What keeps a file from loading: file, row (its text) and the columns whose field does not fit
    its type (none: the row has more or fewer fields than the header).  A second, tolerant reading
    of all columns, for the report of a load that stopped."""
    typed = _file_schema(spark, table, path)
    while (corrupt := "_corrupt") in typed.names:
        corrupt = "_" + corrupt
    blanks = table in SKIP_BLANKS
    read = (spark.read.schema(typed.add(corrupt, T.StringType())).option("header", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
            .option("ignoreLeadingWhiteSpace", blanks).option("enforceSchema", True).csv(path))
    text = T.StructType([T.StructField(n, T.StringType()) for n in typed.names if n != corrupt])
    as_text = F.from_csv(F.col(corrupt), text.simpleString()[7:-1].replace(":", " "),
                         {"ignoreLeadingWhiteSpace": str(blanks).lower()})
    unfit = F.array(*[F.when(F.col(n).isNull() & (F.trim(as_text[n]) != ""), F.lit(n)) for n in text.names])
    return read.where(F.col(corrupt).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col(corrupt).alias("row"),
        F.array_compact(unfit).alias("columns"))


def read_raw_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Typed raw load of customers / products / orders from CSV files.

    Only customers skip blanks after the delimiter (a blank field is NULL
    there); products and orders keep them.  Header names are trimmed.  A
    column that is missing stops the load, except for one with a default.
    """
    schema = schemas.RAW[table]
    file_schema = _file_schema(spark, table, path)
    header, defaults, blanks = file_schema.names, DEFAULTS.get(table, {}), table in SKIP_BLANKS
    df = (spark.read
          .schema(file_schema)
          .option("header", True)
          .option("mode", "FAILFAST")
          .option("ignoreLeadingWhiteSpace", blanks)
          .option("enforceSchema", True)
          .csv(path))
    for name, value in defaults.items():
        if name not in header:
            df = df.withColumn(name, F.lit(value))
    return df.select([F.col(f.name).cast(f.dataType) for f in schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header row and no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def read_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Seed table with declared column types and ',' delimiter.

    With ``path`` the file is read from (shared) storage; without, the
    packaged seed text is parsed by the same CSV reader.  Seeds are small
    by definition (a handful of reference rows).
    """
    reader = (spark.read.schema(schemas.SEEDS[name])
              .option("header", True)
              .option("sep", ",")
              .option("quote", '"')
              .option("mode", "FAILFAST"))
    if path is not None:
        return reader.csv(path)
    with open(os.path.join(SEED_DIR, f"{name}.csv"), encoding="utf-8") as fh:
        lines = [ln for ln in fh.read().splitlines() if ln.strip()]
    rdd = spark.sparkContext.parallelize(lines, 1)
    return reader.csv(rdd)
