"""What the operators share: tables, settings, intermediate tables, word splitting."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark.session import shared_dir

# Characters that the word rules name; fixed values.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# The largest table that is broadcast. Each use measures its table first.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the base tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the session was started."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        name = os.path.join(os.path.realpath(tempfile.mkdtemp()), package.name)
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Hold run-time settings for the actions inside, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that is read more than once to the shared folder and reread it."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """Lower-cased words as an array; none for NULL."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.array_remove(parts, "")


def word_count(text: Column) -> Column:
    """Number of runs of non-blank characters; 0 for NULL."""
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " "))
    return F.when(bare == "", F.lit(0)).otherwise(
        F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit(""))) + 1
    ).cast("bigint")


def row_key(doc_id: Column, text: Column) -> Column:
    """Key of a row by id and text; rows that share it are equal in both."""
    return F.md5(
        F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit("")))
    )
