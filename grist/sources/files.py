"""File sources and sinks.

All of them are plain DataFrame readers/writers; rows are never gathered on
the driver. Writers use ``overwrite`` so a re-run replaces its output
instead of appending duplicates (the reference appends).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grist.operators import exact, tokens
from grist.sources import per_file

DOC_SCHEMA = "text string, url string"


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """S3: one row per file, ``(file, text)``; the file path is the id."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def universal_newlines(text) -> F.Column:
    """Text-mode reading: ``\\r\\n`` and ``\\r`` become ``\\n``."""
    return F.regexp_replace(text, "\r\n?", "\n")


def read_file_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, pos, line, has_nl)`` in file order."""
    files = read_whole_files(spark, path).withColumn("text", universal_newlines(F.col("text")))
    return exact.explode_lines(files, "file", "text")


def dedup_files(spark: SparkSession, path: str) -> DataFrame:
    """S3 + A2 + S8: line-deduplicated file contents, keyed by base name;
    emptied files stay with ``text = ''``."""
    files = read_whole_files(spark, path).withColumn("text", universal_newlines(F.col("text")))
    out = exact.exact_line_dedup(files, "file", "text")
    return out.withColumn("name", F.element_at(F.split("file", "/"), -1))


def read_jsonl(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``{"text", "url"}`` lines with an id of their own: file, start of the
    split and place of the row in its partition. Identical records get different
    ids; retries and re-reads with the same split sizes give the same ones."""
    df = spark.read.schema(DOC_SCHEMA).json(path)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    key = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), place)
    return df.select(key.alias(id_col), "text", "url")


def write_jsonl(df: DataFrame, path: str, with_url: bool = True) -> None:
    """JSON lines; a missing url is written as ``null`` (not dropped)."""
    cols = ["text", "url"] if with_url else ["text"]
    df.select(*cols).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_jsonl_per_file(df: DataFrame, path: str, order: str = "rec", file_col: str = "file") -> None:
    """S6 + S7: one JSON-lines file for each input file, named by
    :func:`output_name`, beside those that ``path`` has already. All rows of an
    input file go to one task, in ``order``; outputs appear when the whole job has
    succeeded, and a rerun replaces the outputs of its own input files alone."""
    spark = df.sparkSession
    spark.dataSource.register(per_file.PerFileSink)
    (df.select(F.col(file_col).alias("file"), F.to_json(F.struct("text", "url"), {"ignoreNullFields": "false"}).alias("line"), F.col(order).alias("place"))
     .repartition("file").sortWithinPartitions("file", "place")
     .select("file", output_name(F.col("file")).alias("name"), "line")
     .write.format("lines_per_file").mode("append").option("path", path).save())


def write_training_lines(df: DataFrame, path: str) -> None:
    """The ``__label__...`` lines as a text file set."""
    df.select("line").write.mode("overwrite").text(path)


def write_token_sequences(packed: DataFrame, path: str) -> None:
    """Packed uint16-range ids as parquet ``(seq, ids)``."""
    tokens.check_uint16(packed).write.mode("overwrite").parquet(path)


def read_token_sequences(spark: SparkSession, path: str) -> DataFrame:
    """S11."""
    return spark.read.parquet(path)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line; empty lines (a trailing newline) are skipped."""
    return spark.read.text(path).select(F.col("value").alias("url")).filter(F.col("url") != "")


def write_url_list(df: DataFrame, path: str) -> None:
    df.select("url").write.mode("overwrite").text(path)


def output_name(file_col) -> F.Column:
    """Base name with its last suffix replaced by ``.jsonl``."""
    base = F.element_at(F.split(file_col, "/"), -1)
    return F.concat(F.regexp_replace(base, r"\.[^.]*$", ""), F.lit(".jsonl"))
