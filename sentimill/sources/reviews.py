"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimill.operators.naive_bayes import NaiveBayesModel
from sentimill.operators.sampling import random_split
from sentimill.sources import csv_blocks

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("Id", "ProductId", "Score", "Time", "Summary", "Text")
    ]
)


# CSV knows no difference between nothing and an empty text, so each is written as a mark of its own; a
# value that looks like a mark is written with one more backslash.
_NULL_MARK, _EMPTY_MARK = "\\N", "\\E"


def _marked(column: str) -> Column:
    value = F.col(column).cast("string")
    text = F.when(value == "", _EMPTY_MARK).when(value.rlike(r"^\\+[NE]$"), F.concat(F.lit("\\"), value))
    return F.when(value.isNull(), _NULL_MARK).otherwise(text.otherwise(value)).alias(column)


def _unmarked(column: str) -> Column:
    value = F.col(column)
    text = F.when(value == _EMPTY_MARK, "").when(value.rlike(r"^\\{2,}[NE]$"), F.expr(f"substring(`{column}`, 2)"))
    return F.when(value != _NULL_MARK, text.otherwise(value)).alias(column)


#: Files larger than this are read in blocks.
SPLIT_BYTES = 128 * 1024 * 1024

_CSV = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file; the contents are not read."""
    return spark.read.format("binaryFile").load(path).agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]


def read_reviews(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = REVIEW_SCHEMA,
    multi_line: bool = True,
    format: str = "csv",
    marked: bool = False,
    split: bool | None = None,
) -> DataFrame:
    """Reviews from CSV with a header (all columns text) or from Parquet, as ``format`` says.

    ``multi_line`` allows line breaks inside quotes.  With ``split`` such files are read in blocks by many tasks, else
    each file by one; by default they are when a file is larger than a block (128 MB).  Both give the same rows as long as
    quotes stand around values only, with quotes inside them doubled; a file with quotes in the middle of bare values
    needs ``split=False``.  ``marked`` files are those of ``write_reviews_csv``.  Without a schema the header names the
    columns.
    """
    if format == "parquet":
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    if format != "csv":
        raise ValueError(f"unknown format: {format}")
    reader = spark.read.options(header=True, multiLine=multi_line, **_CSV)
    whole = (reader if schema is None else reader.schema(schema)).csv(path)
    if multi_line and split is None:
        split = _largest_file(spark, path) > SPLIT_BYTES
    df = csv_blocks.read_csv(spark, path, whole.schema, _CSV) if multi_line and split else whole
    return df.select(*[_unmarked(c) for c in df.columns]) if marked else df


def write_reviews_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Reviews as CSV that ``read_reviews(marked=True)`` reads back unchanged, NULL and empty apart."""
    (
        df.select(*[_marked(c) for c in df.columns])
        .write.mode(mode)
        .options(header=True, quoteAll=True, **_CSV)
        .csv(path)
    )


def read_balanced(
    spark: SparkSession, path: str, format: str = "csv", marked: bool = False, split: bool | None = None
) -> DataFrame:
    """The labelled subset without its index and id columns."""
    return read_reviews(spark, path, None, format=format, marked=marked, split=split).drop("Unnamed: 0", "Id")


ENTRY_SCHEMA = (
    "doc_id bigint, text string, predicted_summary string, score int, time bigint, predicted_score int, "
    "predicted_sentiment int, predicted_proba double, productid string"
)


#: Rows of a file of the stored entries at most.
FILE_ROWS = 1_000_000


def _write_by_product(rows: DataFrame, path: str, file_rows: int) -> None:
    """Files that each hold one range of (product, review), so a product's rows lie together and a large product has many files.

    Files and row groups carry the smallest and largest product, and a Bloom filter of products.
    """
    ranged = rows.repartitionByRange("productid", "doc_id").sortWithinPartitions("productid", "doc_id")
    (
        ranged.write.option("maxRecordsPerFile", file_rows)
        .option("compression", "zstd")
        .option("parquet.bloom.filter.enabled#productid", "true")
        .option("parquet.bloom.filter.expected.ndv#productid", "100000")
        .parquet(path)
    )


def write_entries(entries: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """The scored reviews and the negative ones among them, each clustered by product.

    The number of files depends on the rows alone, not on the number of products.  Products '' and NULL stay apart.
    """
    _write_by_product(entries, f"{path}/entries", file_rows)
    written = entries.sparkSession.read.schema(entries.schema).parquet(f"{path}/entries")
    _write_by_product(written.filter("predicted_score = 0"), f"{path}/negative_reviews", file_rows)


def read_entries(spark: SparkSession, path: str, table: str = "entries") -> DataFrame:
    return spark.read.schema(ENTRY_SCHEMA).parquet(f"{path}/{table}")


def read_sql_table(spark: SparkSession, query: str, **views: DataFrame) -> DataFrame:
    """The result of a SQL query over the session's tables and the given views; errors are raised."""
    return spark.sql(query, **views)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table of a relational store, read in parallel ranges of one numeric column."""
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )


def export_pairs(
    df: DataFrame, path: str, key: str = "Id", share: float = 0.9, mode: str = "error"
) -> None:
    """Text and summary pairs in one folder per split; each pair stays one row."""
    pairs = random_split(df, key, share).select(key, "Text", "Summary", "split")
    pairs.write.mode(mode).partitionBy("split").parquet(path)


def save_model(model: NaiveBayesModel, path: str) -> None:
    """Write the model as two tables below ``path``."""
    model.terms.write.parquet(f"{path}/terms")
    start = [(model.kind, model.start0, model.start1)]
    model.terms.sparkSession.createDataFrame(
        start, "kind string, start0 double, start1 double"
    ).write.parquet(f"{path}/classes")


def load_model(spark: SparkSession, path: str) -> NaiveBayesModel:
    start = spark.read.parquet(f"{path}/classes").first()
    terms = spark.read.parquet(f"{path}/terms")
    return NaiveBayesModel(start["kind"], terms, start["start0"], start["start1"])
