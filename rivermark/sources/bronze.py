"""Bronze change events from a partitioned Parquet layout, with a compatibility gate."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.envelope import BRONZE_VERSION
from ..schemas import CDC_BRONZE

_PARTITIONS = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("event_date", T.DateType()),
    ]
)


def read_bronze(
    spark: SparkSession,
    path: str,
    *,
    entity: str | None = None,
    from_date: date | None = None,
    to_date: date | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """Bronze rows with the address of each row in its file.

    Entity and dates are partition columns, so they prune folders before any file is
    opened.
    """
    schema = T.StructType(CDC_BRONZE.fields + _PARTITIONS.fields)
    reader = spark.read.schema(schema).option("basePath", path)
    rows = reader.parquet(*files) if files else reader.parquet(path)
    if entity:
        rows = rows.where(F.col("entity") == entity)
    if from_date:
        rows = rows.where(F.col("event_date") >= F.lit(from_date))
    if to_date:
        rows = rows.where(F.col("event_date") <= F.lit(to_date))
    return rows.select(
        *CDC_BRONZE.fieldNames(),
        F.col("_metadata.file_path").alias("source_object_uri"),
        F.col("_metadata.row_index").alias("source_row_index"),
    )


def schema_problems(spark: SparkSession, file: str) -> list[str]:
    """Columns a Parquet file lacks or holds under another type; extra ones are fine."""
    try:
        actual = {f.name: f.dataType for f in spark.read.parquet(file).schema.fields}
    except (AnalysisException, PySparkException):
        return ["unreadable"]
    problems = []
    for field in CDC_BRONZE.fields:
        if field.name not in actual:
            problems.append(f"missing:{field.name}")
        elif actual[field.name] != field.dataType:
            problems.append(f"type:{field.name}")
    return sorted(problems, key=lambda p: (p.startswith("type"), p))


def incompatible_objects(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """Files of a run that cannot be read as Bronze, with the reason.

    Only footers are read, for the bounded number of objects of one run.
    """
    found = {}
    for file in files:
        problems = schema_problems(spark, file)
        if problems:
            found[file] = f"CDC Bronze schema is incompatible ({', '.join(problems)})"
    return found


def unsupported_versions(rows: DataFrame, *, supported: str = BRONZE_VERSION) -> DataFrame:
    """Objects with any other schema version than the supported one."""
    return (
        rows.groupBy("source_object_uri")
        .agg(F.count_if(~F.col("schema_version").eqNullSafe(F.lit(supported))).alias("_other"))
        .where("_other > 0")
        .select(
            "source_object_uri", F.lit("SCHEMA_VERSION_UNSUPPORTED").alias("error_code")
        )
    )


def missing_columns(expected: T.StructType, actual: T.StructType, spark: SparkSession) -> DataFrame:
    """(name, type) pairs that are expected and not there."""

    def pairs(schema: T.StructType) -> DataFrame:
        rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]
        return spark.createDataFrame(rows, "name string, type string")

    return pairs(expected).exceptAll(pairs(actual))
