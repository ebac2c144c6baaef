"""File sources. Readers declare text columns and leave coercion to the normalisers."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fixed
from ..operators.unify import unify_firewall_log, unify_flow_csv, unify_flow_table, unify_payloads, union_sources


def flow_parquet(spark: SparkSession, *paths: str, label_mode: str = "keywords") -> DataFrame:
    """Flow tables, each normalised by its own columns, then concatenated."""
    return union_sources(*[unify_flow_table(spark.read.parquet(path), label_mode=label_mode) for path in paths])


# A line in which a field opens a quote that the line does not close; a quoted field that ends in a comma looks the same.
OPEN_QUOTE = r'(?:^|,)\s*"(?:[^"]|"")*$'


def csv_heads(spark: SparkSession, files: Sequence[str]) -> list:
    """(path, header, broken) of each file: its first line, and whether a line may break inside quotes. One job over the lines of all files."""
    lines = spark.read.text(list(files)).select(
        F.col("_metadata.file_path").alias("path"), (F.col("_metadata.file_block_start") == 0).alias("first"), F.monotonically_increasing_id().alias("place"), "value"
    )
    header = F.min_by("value", F.when(F.col("first"), F.col("place")))
    return lines.groupBy("path").agg(header.alias("header"), F.max(F.col("value").rlike(OPEN_QUOTE)).alias("broken")).collect()


def read_csv_directory(spark: SparkSession, folder: str, multi_line: bool | None = None) -> list[DataFrame]:
    """All ``*.csv`` of a folder as text columns, one frame for each header that occurs. Bad bytes become U+FFFD, null words become null.

    Files may differ in names and order of their columns: one job reads the headers of all, and files with the same header are read together.
    Records with line breaks inside quotes stay whole: files that may hold such are found in the same job and read whole, each by one
    task; all others are split. ``multi_line`` decides for all files instead.
    """
    files = _file_names(spark, folder, "*.csv", recursive=False)
    if not files:
        raise FileNotFoundError(f"no CSV files in {folder}")
    groups: dict[tuple[str, bool], list[str]] = {}
    for head in csv_heads(spark, [unquote(f) for f in files]):  # a row for each file; empty files have none
        broken = head.broken if multi_line is None else multi_line
        groups.setdefault((head.header, broken), []).append(unquote(head.path))
    reader = spark.read.options(header=True, encoding="UTF-8", escape='"', enforceSchema=False)
    return [_csv_values(reader.option("multiLine", broken).csv(sorted(same))) for (_, broken), same in sorted(groups.items())]


def _csv_values(frame: DataFrame) -> DataFrame:
    def value(name: str) -> Column:
        column = F.col("`" + name.replace("`", "``") + "`")
        return F.when(~column.isin(fixed.CSV_NULL_WORDS), column).alias(name)

    return frame.select(*[value(name) for name in frame.columns])


def flow_csv(spark: SparkSession, folder: str, label_mode: str = "keywords", multi_line: bool | None = None) -> DataFrame:
    """Flow records; column names are resolved for each header on its own."""
    return union_sources(*[unify_flow_csv(part, label_mode=label_mode) for part in read_csv_directory(spark, folder, multi_line)])


def firewall_csv(spark: SparkSession, folder: str, multi_line: bool | None = None) -> DataFrame:
    return union_sources(*[unify_firewall_log(part) for part in read_csv_directory(spark, folder, multi_line)])


def _file_names(spark: SparkSession, folder: str, pattern: str, recursive: bool) -> list[str]:
    """Names of matching files, from the listing the reader makes anyway; no content is read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(folder).inputFiles()


def payload_files(spark: SparkSession, root: str, pattern: str = "*.json") -> list[str]:
    """The merged payload files if either exists, else every JSON file below the root, sorted."""
    files = _file_names(spark, root, pattern, recursive=True)
    preferred = [f for want in fixed.PREFERRED_PAYLOAD_FILES for f in files if unquote(f).endswith("/" + want)]
    if preferred:
        return preferred
    if not files:
        raise FileNotFoundError(f"no {pattern} files in {root}")
    return sorted(files)


def payload_rows(spark: SparkSession, root: str, json_lines: bool = False, pattern: str = "*.json") -> DataFrame:
    """(payload, label): elements of JSON arrays, labelled by the path below the root.

    An array file is one value and so one task. Large collections should be stored as JSON lines,
    one JSON text per line; ``json_lines`` reads those in splits.
    """
    files = payload_files(spark, root, pattern)
    # Paths come back percent-encoded where they hold special characters.
    text = spark.read.text([unquote(f) for f in files], wholetext=not json_lines).select("value", F.col("_metadata.file_path").alias("path"))
    start = F.instr(F.lower("path"), F.lit(root.rstrip("/").lower()))
    below = F.lower(F.substr("path", start + F.lit(len(root.rstrip("/")))))
    label = F.when(F.contains(below, F.lit("legitimate")), 0).otherwise(1)
    if json_lines:
        payload = F.try_parse_json("value")
        rows = text.select(F.coalesce(payload.cast("string"), F.lit("")).alias("payload"), label.alias("label"))
        return rows
    elements = F.from_json("value", "array<string>")
    return text.select(F.explode(elements).alias("payload"), label.alias("label")).select(
        F.coalesce("payload", F.lit("")).alias("payload"), "label"
    )


def payload_json(spark: SparkSession, root: str, json_lines: bool = False) -> DataFrame:
    return unify_payloads(payload_rows(spark, root, json_lines))


INFERENCE_INDEX = "index"


def _shape(spark: SparkSession, path: str) -> str:
    """Shape of the inference files of a path, which must agree: what the text opens with, however much space is before it."""
    opening = F.regexp_extract("value", r"^[\s\x{FEFF}]*(\{|\[\s*\{|\[)", 1)
    text = spark.read.text(path, wholetext=True).filter(F.trim("value") != "")
    found = {row.opening for row in text.select(F.regexp_replace(opening, r"\s", "").alias("opening")).distinct().limit(5).collect()}
    shapes = {"{": "object", "[{": "objects", "[": "payloads"}
    if len(found) != 1 or not found <= shapes.keys():
        raise ValueError("input must be a JSON object, a list of objects, or a list of payload strings")
    return shapes[found.pop()]


def inference_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows to score, with their position as ``index``, from any of four shapes: one object, an
    object with a ``records`` list, a list of objects, or a list of payloads.

    Columns are text, or null where a record lacks the field.
    """
    shape = _shape(spark, path)
    text = spark.read.text(path, wholetext=True)
    if shape == "payloads":
        items = F.posexplode(F.from_json("value", "array<string>"))
        return text.select(items).select(
            F.col("pos").cast("long").alias(INFERENCE_INDEX), F.coalesce("col", F.lit("")).alias("payload")
        )
    inferred = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path).schema
    field = inferred["records"].dataType if "records" in inferred.names else None
    if shape == "object" and isinstance(field, T.ArrayType):
        rows = T.ArrayType(_all_text(field.elementType))
        items = F.from_json("value", T.StructType([T.StructField("records", rows)]))["records"]
    elif shape == "object":
        listed = F.concat(F.lit("["), F.col("value"), F.lit("]"))
        items = F.from_json(listed, T.ArrayType(_all_text(inferred)))
    else:
        items = F.from_json("value", T.ArrayType(_all_text(inferred)))
    return text.select(F.posexplode(items)).select(F.col("pos").cast("long").alias(INFERENCE_INDEX), "col.*")


def _all_text(record: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in record.fields])


def inference_json_lines(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Large inputs: one record per line, read in splits, with declared columns."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.read.schema(schema).json(path)
