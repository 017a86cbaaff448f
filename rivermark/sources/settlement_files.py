"""Settlement files as distributed lines, records and inventories.

Files are read by line, so a large file is split over tasks. Quoted line breaks are
put together again only in files that have them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import inventory, scan
from ..operators.contract import Contract

# Lines that are hashed together, and bytes that are landed together.
_LINES_PER_HASH = 4096
_BLOCK_BYTES = 1 << 20

# Fixed value: a field with more characters than this makes the file unreadable.
FIELD_LIMIT = 131_072

_BOM = "\ufeff"
_MISSING = "\u0002"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder by name, empty ones included: path, name and size."""
    reader = spark.read.format("binaryFile").load(path)
    filled = _plain(reader.select("path", "length"))
    names = [(unquote(name),) for name in reader.inputFiles()]
    every = _plain(spark.createDataFrame(names, "path string"))
    return every.join(filled, "path", "left").select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.coalesce("length", F.lit(0)).alias("length"),
    )


def read_lines(spark: SparkSession, path: str, *, only: Sequence[str] | None = None) -> DataFrame:
    """Lines with their file, block and place; the carriage return is cut off.

    ``_raw`` is the line as it stands, ``_size`` the file's length. With ``only``, the
    files of these paths; others are left out when Spark lists the folder.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    spelled = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    spelled = F.regexp_replace(spelled, "^file:/+", "file:///")
    if only is not None:
        text = text.where(spelled.isin(list(only)))
    return text.select(
        spelled.alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
        F.regexp_replace("value", "\r$", "").alias("line"),
        (~F.is_valid_utf8("value")).alias("_garbled"),
        F.col("value").alias("_raw"),
        F.col("_metadata.file_size").alias("_size"),
    )


def content_ids(spark: SparkSession, path: str) -> DataFrame:
    """Content identity of each file with a line, and whether it has a byte order mark.

    The same function of the bytes for every size: lines are hashed where they are read,
    4,096 line hashes make one hash, and the file's length with these in order is hashed
    once more. It isn't the plain SHA-256 of the file. The reader leaves out line ends
    and a byte order mark; the length tells which of these a file has.
    """
    narrow = read_lines(spark, path).select(
        "path",
        "_block",
        "_place",
        "_size",
        F.octet_length("_raw").alias("_bytes"),
        F.unhex(F.sha2(F.col("_raw").cast("binary"), 256)).alias("_hash"),
    )
    numbered = scan.row_number(
        narrow, groups=["path"], levels=["_block"], order=["_place"], name="_number"
    )

    def in_order(at: str, value: Column) -> Column:
        pairs = F.sort_array(F.collect_list(F.struct(F.col(at), value.alias("h"))))
        return F.array_join(F.transform(pairs, lambda x: x["h"]), "")

    parts = numbered.groupBy("path", scan.piece(F.col("_number") - 1, _LINES_PER_HASH).alias("_part")).agg(
        F.sha2(in_order("_number", F.hex("_hash")), 256).alias("_hash"),
        F.sum(F.col("_bytes") + 1).alias("_bytes"),
        F.max("_size").alias("_size"),
    )
    return parts.groupBy("path").agg(
        _content_id(F.max("_size"), in_order("_part", F.col("_hash"))).alias("checksum_sha256"),
        (F.max("_size") - F.sum("_bytes") >= 2).alias("has_bom"),
    )


def _content_id(length: Column, hashes: Column) -> Column:
    return F.sha2(F.concat_ws(":", length, hashes), 256)


def _plain(files: DataFrame) -> DataFrame:
    """Paths spelled the way file metadata of text rows spells them."""
    return files.withColumn("path", F.regexp_replace("path", "^file:/+", "file:///"))


def _field_pattern(delimiter: str) -> str:
    sep = re.escape(delimiter)
    return rf'(?:"(?:[^"]|""){{0,{FIELD_LIMIT}}}+"|[^"{sep}][^{sep}]{{0,{FIELD_LIMIT - 1}}}+|)'


def _line_facts(lines: DataFrame, contract: Contract) -> DataFrame:
    """One row per file: its header, and whether lines are garbled or leave a quote open."""
    sep, field = re.escape(contract.delimiter), _field_pattern(contract.delimiter)
    opens = F.col("line").rlike(rf'^(?:{field}{sep})*+"(?:[^"]|"")*+$')
    at_start = F.col("_block") == 0
    return lines.groupBy("path").agg(
        F.min_by(F.when(at_start, F.col("line")), F.when(at_start, F.col("_place"))).alias(
            "_header"
        ),
        F.min_by(F.when(at_start, F.col("_garbled")), F.when(at_start, F.col("_place"))).alias(
            "_garbled_header"
        ),
        F.count_if("_garbled").alias("_garbled_lines"),
        F.bool_or(opens).alias("_torn"),
    )


def _records(lines: DataFrame, facts: DataFrame, contract: Contract) -> DataFrame:
    """Adds ``number`` (1 for the header) and glues lines a quoted field runs over."""
    place = {"groups": ["path"], "levels": ["_block"], "order": ["_place"]}
    torn_files = facts.where("_torn").select("path")
    if torn_files.isEmpty():
        return scan.row_number(lines.where("line <> ''"), name="number", **place)
    whole = lines.join(torn_files, "path", "left_anti")
    torn = lines.join(torn_files, "path")
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    torn = scan.running_total(torn, value=quotes, name="_quotes", **place)
    inside = ((F.col("_quotes") - quotes) % 2) == 1
    torn = scan.running_total(
        torn.withColumn("_inside", inside),
        value=F.when(~F.col("_inside"), 1).otherwise(0),
        name="_record",
        **place,
    )
    torn = torn.withColumn("_line", F.struct("_block", "_place", "line"))
    # No record of the contract's fields, each within the limit and its quotes doubled,
    # is longer; one that is has a field above it, or surplus fields, and is refused.
    limit = (2 * FIELD_LIMIT + 4) * len(contract.fields)
    sizes = torn.groupBy("path", "_record").agg(
        F.min("_block").alias("_first_block"),
        F.min(F.struct("_block", "_place")).alias("_at"),
        (F.sum(F.length("line") + 1) > limit).alias("_oversize"),
    )
    # A record is only collected after its size is known to be small.
    fits = torn.join(sizes.where(~F.col("_oversize")), ["path", "_record"])
    glued = fits.groupBy("path", "_record", "_at").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("_line")), lambda x: x["line"]), "\n")
        .alias("line")
    )
    oversize = sizes.where("_oversize").select(
        "path", F.col("_at._block").alias("_block"), F.col("_at._place").alias("_place"),
        F.lit('"').alias("line"),
    )
    together = (
        glued.select(
            "path",
            F.col("_at._block").alias("_block"),
            F.col("_at._place").alias("_place"),
            "line",
        )
        .unionByName(oversize)
        .unionByName(whole.select("path", "_block", "_place", "line"))
    )
    return scan.row_number(together.where("line <> ''"), name="number", **place)


def identify_files(
    spark: SparkSession,
    path: str,
    contract: Contract,
    *,
    expected_partner: str | Column | None = None,
) -> DataFrame:
    """One row per file of a folder: the parts of its name and its content's identity.

    ``error_code`` says what is wrong with the name.
    """
    names = inventory.parse_file_names(
        list_files(spark, path), contract, expected_partner=expected_partner
    )
    unread = _content_id(F.col("length"), F.lit(""))
    return names.join(content_ids(spark, path), "path", "left").withColumns(
        {
            "checksum_sha256": F.coalesce("checksum_sha256", unread),
            "has_bom": F.coalesce("has_bom", F.lit(False)),
        }
    )


def read_settlements(
    spark: SparkSession,
    path: str,
    contract: Contract,
    *,
    expected_partner: str | Column | None = None,
    work: str | None = None,
    files: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Settlement files of a folder: raw rows of the good files, and one row per file.

    ``files`` are those of ``identify_files`` to read, all by default; only their paths
    come to the driver, as they do whenever Spark lists a folder. File rows carry
    ``error_code`` (NULL when rows can be judged), the parts of the file name and the
    content's identity. Raw rows carry the contract's columns as text; NULL means the
    record was too short for the column. With ``work``, a folder the cluster shares, the
    file facts and the records are written there and read once.
    """
    only = None
    if files is None:
        names = identify_files(spark, path, contract, expected_partner=expected_partner)
    else:
        names, only = files, [r["path"] for r in files.select("path").collect()]
    lines = read_lines(spark, path, only=only).drop("_raw", "_size")
    facts = _line_facts(lines, contract)
    if work:
        facts.write.parquet(f"{work}/line-facts")
        facts = spark.read.parquet(f"{work}/line-facts")
    records = _records(lines, facts, contract).select("path", "number", "line")
    if work:
        records.write.parquet(f"{work}/records")
        records = spark.read.parquet(f"{work}/records")
    field, sep = _field_pattern(contract.delimiter), re.escape(contract.delimiter)
    wellformed = F.col("line").rlike(rf"^{field}(?:{sep}{field})*+$")
    options = {"sep": contract.delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    padded = F.concat("line", F.lit((contract.delimiter + _MISSING) * len(contract.fields)))
    row = F.from_csv(padded, contract.raw_schema().simpleString()[7:-1].replace(":", " "), options)

    counts = records.groupBy("path").agg(
        F.count_if(~wellformed).alias("_bad_lines"),
        F.count_if(F.col("number") > 1).alias("record_count"),
    )
    header = F.regexp_replace("_header", '"', "")
    code = (
        F.when(F.col("error_code").isNotNull(), F.col("error_code"))
        .when(F.col("_header").isNull(), "EMPTY_FILE")
        .when(F.col("_garbled_header"), "INVALID_ENCODING")
        .when(F.col("has_bom") | (header != contract.delimiter.join(contract.names)), "INVALID_FILE_SCHEMA")
        .when(F.col("_garbled_lines") > 0, "INVALID_ENCODING")
        .when(F.col("_bad_lines") > 0, "INVALID_CSV")
        .when(F.coalesce("record_count", F.lit(0)) == 0, "EMPTY_FILE")
    )
    files = (
        names.join(facts, "path", "left")
        .join(counts, "path", "left")
        .withColumn("error_code", code)
        .drop("_header", "_garbled_header", "_garbled_lines", "_torn", "_bad_lines")
    )
    good = files.where(F.col("error_code").isNull()).select(
        "path",
        F.col("file_name").alias("source_file_name"),
        F.col("checksum_sha256").alias("source_checksum"),
        F.col("partner_id").alias("file_partner_id"),
        F.col("settlement_date").alias("file_settlement_date"),
    )
    values = [
        F.when(F.col(f"_row.{n}") == _MISSING, F.lit(None))
        .otherwise(F.coalesce(F.col(f"_row.{n}"), F.lit("")))
        .alias(n)
        for n in contract.names
    ]
    rows = (
        records.where("number > 1")
        .select("path", F.col("number").alias("source_row_number"), row.alias("_row"))
        .join(good, "path")
        .select("path", *good.columns[1:], "source_row_number", *values)
    )
    return rows, files


def raw_blocks(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """Bytes of the given files, unchanged, in numbered blocks of about a megabyte.

    ``content`` of a file's blocks in the order of ``block`` is the file. A block begins
    with the line that begins in it, so none is larger than that and a line.
    """
    only = [r["path"] for r in files.select("path").collect()]
    lines = read_lines(spark, path, only=only).select("path", "_block", "_place", "_raw")
    placed = scan.running_total(
        lines,
        groups=["path"],
        levels=["_block"],
        order=["_place"],
        value=F.octet_length("_raw").cast("bigint") + 1,
        name="_upto",
    )
    start = F.col("_upto") - F.octet_length("_raw") - 1
    joined = placed.groupBy("path", scan.piece(start, _BLOCK_BYTES).alias("block")).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("_upto", "_raw"))), lambda x: x["_raw"]), "\n"
        ).alias("_text"),
        F.max("_upto").alias("_upto"),
    )
    text_bytes = F.col("length") - F.when(F.col("has_bom"), 3).otherwise(0)
    mark = F.lit(_BOM)
    content = F.concat(
        F.when(F.col("has_bom") & (F.col("block") == 0), mark).otherwise(""),
        "_text",
        F.when(F.col("_upto") <= text_bytes, "\n").otherwise(""),
    )
    # A file without lines is empty, or nothing but a byte order mark.
    content = F.coalesce(content, F.when(F.col("length") == 3, mark), F.lit(""))
    return files.join(joined, "path", "left").select(
        *files.columns, F.coalesce("block", F.lit(0)).alias("block"), content.cast("binary").alias("content")
    )
