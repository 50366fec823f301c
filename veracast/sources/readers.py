"""File readers. Every reader can add `seq`, the input order that decides which row is last."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from . import splits

CORRUPT = "_corrupt_record"
ORDER_TYPE = "struct<at: timestamp, file: string, split: bigint, row: bigint>"


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What `read` gives, or None where its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return None


def with_input_order(df: DataFrame, name: str = "seq") -> DataFrame:
    """Order of files by time and name, of splits in a file, of rows in a split."""
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_modification_time").alias("at"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def counts_as_text(rows: DataFrame) -> DataFrame:
    """Variant columns as text: a JSON number loses its fraction, a string stays as it is."""
    found = {}
    for name, kind in rows.dtypes:
        if kind == "variant":
            value = F.col(name)
            number = F.schema_of_variant(value) != "STRING"
            whole = F.when(number, F.try_variant_get(value, "$", "bigint").cast("string"))
            found[name] = F.coalesce(whole, F.try_variant_get(value, "$", "string"))
    return rows.withColumns(found) if found else rows


def read_jsonl(spark: SparkSession, path: str, schema: str, ordered: bool = False, quarantine: bool = False) -> DataFrame:
    """JSON lines. A missing path is an empty table, blank lines are skipped and a bad line ends
    the read (`naming_bad_lines` tells which); counts declared as variant become text of whole numbers; with `quarantine` bad lines are kept whole in `_corrupt_record`."""
    if quarantine:
        schema = f"{schema}, {CORRUPT} string"
    reader = spark.read.schema(schema)
    reader = (
        reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        if quarantine
        else reader.option("mode", "FAILFAST")
    )
    try:
        rows = reader.json(path)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        empty = counts_as_text(spark.createDataFrame([], schema))
        return empty.withColumn("seq", F.lit(None).cast(ORDER_TYPE)) if ordered else empty
    rows = with_input_order(rows) if ordered else rows
    return counts_as_text(rows)


def read_csv(spark: SparkSession, path: str, limit: int | None = None, schema: str | None = None) -> DataFrame:
    """CSV with a header; a byte-order mark is dropped and empty fields are NULL. Quoted fields may hold line
    breaks, and still many tasks read one file (see `splits`). `limit` takes the first rows in input order."""
    try:
        fields = spark.createDataFrame([], schema).schema if schema else splits.csv_schema(spark, path)
        records = splits.csv_records(spark, path) if fields else None
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return spark.createDataFrame([], schema or StructType())
    if records is None:
        return spark.createDataFrame([], StructType())
    rows = splits.parsed_csv(records, fields, "_order")
    if limit is not None:
        rows = rows.orderBy("_order").limit(max(0, limit))
    return rows.drop("_order")


def read_json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines by suffix; else one array, one object with `records`, or one object per file."""
    if path.rstrip("/").endswith(".jsonl"):
        return read_jsonl(spark, path, schema)
    fields = spark.createDataFrame([], schema).schema
    wrapped = StructType([*fields]).add("records", ArrayType(fields))
    rows = spark.read.schema(wrapped).option("multiLine", True).option("mode", "FAILFAST").json(path)
    own = F.array(F.struct(*fields.names))
    return rows.select(F.inline(F.coalesce("records", own)))


def read_seed_list(spark: SparkSession, path: str, strip: str = "") -> DataFrame:
    """Trimmed distinct lines in order of first appearance (`seq`), without blanks and comments."""
    lines = with_input_order(spark.read.text(path))
    value = F.trim("value")
    kept = lines.select(value.alias("value"), "seq").where((F.col("value") != "") & ~F.col("value").startswith("#"))
    if strip:
        kept = kept.withColumn("value", F.ltrim("value", F.lit(strip))).where(F.col("value") != "")
    return kept.groupBy("value").agg(F.min("seq").alias("seq"))


@contextmanager
def naming_bad_lines(spark: SparkSession, inputs: Mapping[str, str]) -> Iterator[None]:
    """Work on JSON lines of these files (path -> schema): if a bad line ends it, the error names its file
    and line. Lines are only numbered then."""
    try:
        yield
    except Exception as error:
        if "MALFORMED_RECORD_IN_PARSING" in str(error):
            splits.raise_first_bad_line(spark, inputs)
        raise


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their order, for checks on raw JSON lines."""
    return with_input_order(spark.read.text(path), "line")
