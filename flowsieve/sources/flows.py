"""Flow CSV files in, reports out.

A source is any path component that ends in ``.csv``: a single file, or a directory of part files as Spark
writes them. Its name tags the rows as ``source_file``.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import union_all
from ..schema import FEATURE_NAMES

# Texts that mean "missing" in a CSV cell.
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                 "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Source name tokens left out of training and of the cross-dataset table.
TRAIN_EXCLUDE = ["mock"]
CROSS_EVAL_EXCLUDE = ["mock", "monday"]


def _source_name() -> Column:
    """Path component ending in ``.csv`` (the suffix is case-sensitive), without a partition prefix."""
    name = F.regexp_extract("_metadata.file_path", r"([^/=]+\.csv)(?:/|$)", 1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _wanted(exclude: Iterable[str]) -> Column:
    """A predicate on file metadata alone, so excluded files are pruned before they are opened."""
    keep = _source_name() != ""
    for token in exclude:
        keep = keep & ~F.contains(F.lower(_source_name()), F.lit(token.lower()))
    return keep


def header_names(line: str) -> list[str]:
    """Column names of a header line: stripped, the n-th repeat of a name suffixed ``.n``."""
    seen: dict[str, int] = {}
    names = []
    for raw in next(csv.reader([line])):
        name = raw.strip()
        repeat = seen.get(name, 0)
        seen[name] = repeat + 1
        names.append(f"{name}.{repeat}" if repeat else name)
    return names


def _typed(raw: DataFrame) -> DataFrame:
    """Features to doubles (unreadable text becomes null); labels and other columns stay text."""
    numeric = {name for pair in FEATURE_NAMES for name in pair}
    snake = dict(FEATURE_NAMES)
    columns = []
    for name in raw.columns:
        text = F.col(f"`{name}`")
        value = F.when(~text.isin(MISSING_TEXTS), text)
        if name in numeric:
            value = F.trim(value).try_cast("double")
        columns.append(value.alias(snake.get(name, name)))
    return raw.select(*columns, _source_name().alias("source_file"))


def _read_with(spark: SparkSession, paths: str | list[str], header: str) -> DataFrame:
    schema = ", ".join(f"`{name}` STRING" for name in header_names(header))
    return (spark.read.option("header", True).option("recursiveFileLookup", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .schema(schema).csv(paths))


def read_flows(spark: SparkSession, path: str, exclude: Iterable[str] = ()) -> DataFrame:
    """All flow CSV sources below ``path`` as one table tagged with ``source_file``.

    Names come from each file's own header, features are read as doubles without an inference pass. Files are read by
    header, one table for each, and concatenated by name; a column that a file lacks is null there.
    """
    exclude = list(exclude)
    lines = (spark.read.option("recursiveFileLookup", True).text(path)
             .where(_wanted(exclude) & (F.col("_metadata.file_block_start") == 0)))
    per_file = (lines.select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("i"))
                .groupBy("file").agg(F.min_by("value", "i").alias("header")))
    by_header: dict[str, list[str]] = {}
    for row in per_file.toLocalIterator():      # as long as the listing that any file source holds
        by_header.setdefault(row["header"], []).append(row["file"])
    if not by_header:
        raise FileNotFoundError(f"no flow CSV below {path}")
    if len(by_header) == 1:
        return _typed(_read_with(spark, path, next(iter(by_header))).where(_wanted(exclude)))
    return union_all(*[_typed(_read_with(spark, sorted(files), header)) for header, files in sorted(by_header.items())])


def stage_flows(flows: DataFrame, path: str) -> DataFrame:
    """Write flows as Parquet partitioned by source and read them back with a unique ``row_id``.

    The id is the source's name, a 128-bit hash of the row and the number of its copy, so it does not depend on how
    files were cut or how many tasks read them. Equal rows are counted before they are shuffled. Later passes prune
    columns and sources, which text files cannot.
    """
    spark = flows.sparkSession
    columns = [F.col(f"`{c}`") for c in flows.columns]
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(salt), *columns)), 16, "0") for salt in (1, 2)]
    counted = flows.groupBy(*columns).agg(F.count("*").alias("_copies"))
    numbered = counted.select(*columns, F.concat_ws(":", "source_file", F.concat(*halves)).alias("_id"),
                              F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("_copy"))
    rows = numbered.select(*columns, F.concat_ws(":", "_id", F.col("_copy").cast("string")).alias("row_id"))
    rows.write.mode("overwrite").partitionBy("source_file").parquet(path)
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.option("recursiveFileLookup", True).text(path).isEmpty()
    except Exception as error:  # noqa: BLE001 - only a missing path means "try the next one"
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def resolve_source(spark: SparkSession, real: str, mock: str, generate: Callable[[], DataFrame]) -> str:
    """The real path if it exists, else the mock path, generated and saved first when it is missing too."""
    for path in (real, mock):
        if _exists(spark, path):
            return path
    generate().write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(mock)
    return mock


def write_flows_csv(flows: DataFrame, path: str) -> None:
    """One ``<source>.csv`` directory per source, with CSV headers."""
    headers = {snake: name for name, snake in FEATURE_NAMES}
    named = flows.select(*[F.col(c).alias(headers.get(c, "Label" if c == "label" else c)) for c in flows.columns])
    (named.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).partitionBy("source_file").csv(path))


def write_metrics(table: DataFrame, path: str, t1: float, t2: float, fmt: str = "parquet") -> None:
    """Cross-dataset report with the thresholds that produced it; the table has one row per source."""
    report = table.withColumn("threshold_1", F.lit(float(t1))).withColumn("threshold_2", F.lit(float(t2)))
    writer = report.orderBy("source_file").write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


