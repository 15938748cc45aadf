"""Cleaning, projection and labelling of flow tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import binarize, float32_round
from ..schema import FEATURES, LABEL_COLUMNS
from ..session import materialize

DEALT_ROWS = 1_000_000          # distinct rows that one task holds in memory
HASH_PLACES = 1 << 27           # bits that tell which hashes occur again: 16 MB, however many there are
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)


def clean_columns(df: DataFrame) -> DataFrame:
    """Strip white space around every column name; two names that become equal are an error."""
    names = [name.strip() for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"column names collide after stripping: {clashes}")
    return df.toDF(*names)


def drop_non_finite(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop every row with a null, NaN or infinite value.

    All columns count by default, unmodelled ones included; ``subset`` restores column pruning where
    full parity is not needed. The test is one filter, so it stays next to the scan.
    """
    keep: Column = F.lit(True)
    for field in df.schema.fields:
        if subset is not None and field.name not in subset:
            continue
        col = F.col(f"`{field.name}`")
        # NaN sorts above infinity, so one comparison rejects null, NaN and both infinities.
        keep = keep & (F.abs(col) < float("inf") if isinstance(field.dataType, FLOATS) else col.isNotNull())
    return df.where(keep)


def drop_duplicates(df: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Exact duplicates over all columns; ``ignore`` names columns that are no data (row numbers, file tags).

    Grouping by the row itself aggregates before the shuffle, so a row copied many times leaves each
    task once. Ignored columns are dropped because the copies disagree on them.
    """
    return df.drop(*ignore).dropDuplicates()


def dealt_by_row(df: DataFrame, ignore: tuple[str, ...] = (), rows_a_part: int = DEALT_ROWS) -> DataFrame:
    """The rows dealt by their content, so that those who drop duplicates next find copies in one part and shuffle no further.

    Collapsing inside each task first pays where rows are copied often; where most are distinct it only holds a task's
    rows in memory, and spills. So a table stays as it is when it is small or at least half of it are copies.
    """
    data = [F.col(f"`{c}`") for c in df.columns if c not in ignore]
    rows, distinct = df.agg(F.count("*"), F.approx_count_distinct(F.xxhash64(*data))).first()
    if rows <= rows_a_part or 2 * distinct < rows:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_a_part)), *data)


def distinct_of_sources(df: DataFrame, ignore: tuple[str, ...] = (), source: str = "source_file") -> DataFrame:
    """Distinct rows with the source each belongs to; where that is no data, copies from several sources belong to the first by name."""
    if source not in df.columns:
        return drop_duplicates(df, ignore).withColumn(source, F.lit(None).cast("string"))
    if source not in ignore:
        return drop_duplicates(df, ignore)
    data = [F.col(f"`{c}`") for c in df.columns if c not in ignore]
    return df.groupBy(*data).agg(F.min(source).alias(source))


def distinct_by_hash(df: DataFrame, ignore: tuple[str, ...] = (), rows_a_part: int = DEALT_ROWS, places: int = HASH_PLACES,
                     source: str = "source_file") -> DataFrame:
    """`distinct_of_sources` for a large table in which most rows occur once: of those, only a hash is shuffled.

    A row whose 64-bit hash occurs once is distinct as it is. The hashes that occur again are marked in a bitmap of fixed size;
    rows that it names, some of them for a neighbour's sake, are compared whole. A small table, or one where more than
    half of the rows occur again, is compared whole as it is.
    """
    rows = df.count()
    if rows <= rows_a_part:
        return distinct_of_sources(df, ignore, source)
    data = [F.col(f"`{c}`") for c in df.columns if c not in ignore]
    counts = df.select(F.xxhash64(*data).alias("_hash")).groupBy("_hash").agg(F.count("*").alias("_rows")).where("_rows > 1")
    held = (counts.select("_rows", F.pmod("_hash", F.lit(places)).alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"), F.sum("_rows").alias("_rows")))
    word = lambda i: F.conv(F.hex(F.substring("_bits", i * 4 + 1, F.lit(4))), 16, 10).cast("long")  # noqa: E731 - 32 bits, first byte highest
    bits = materialize(held.select("_bucket", "_rows", F.transform(F.sequence(F.lit(0), F.lit(1023)), word).alias("_words")), "repeated")
    again = bits.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    if 2 * again > rows:
        return distinct_of_sources(dealt_by_row(df, ignore, rows_a_part), ignore, source)
    at = F.bitmap_bit_position("_place")
    here = F.get("_words", F.shiftright(at, 5).cast("int"))
    bit = F.lit(24) - at.bitwiseAND(F.lit(24)) + at.bitwiseAND(F.lit(7))
    named = F.coalesce(F.getbit(here, bit.cast("int")) == 1, F.lit(False))
    placed = df.withColumn("_place", F.pmod(F.xxhash64(*data), F.lit(places)))               # hashed once, before the join
    marked = placed.join(F.broadcast(bits.select("_bucket", "_words")), F.bitmap_bucket_number("_place") == F.col("_bucket"), "left")
    columns = [F.col(f"`{c}`") for c in df.columns]
    once, doubtful = marked.where(~named).select(columns), marked.where(named).select(columns)
    if again > rows_a_part:
        doubtful = doubtful.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-again // rows_a_part)), *data)
    once = once.drop(*[c for c in ignore if c != source])
    once = once if source in df.columns else once.withColumn(source, F.lit(None).cast("string"))
    return once.unionByName(distinct_of_sources(doubtful, ignore, source))


def duplicate_counts(df: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows before and after `drop_duplicates`, and how many it removes, in one aggregation."""
    data = df.drop(*ignore)
    groups = data.groupBy(*[F.col(f"`{c}`") for c in data.columns]).agg(F.count("*").alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
    ).withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def with_row_id(df: DataFrame, name: str = "row_id", ignore: tuple[str, ...] = ()) -> DataFrame:
    """Add a 128-bit id computed from the row's content, ``ignore`` left out; unique once duplicates are gone."""
    cols = [F.col(f"`{c}`") for c in df.columns if c not in ignore]
    halves = [F.hex(F.xxhash64(F.lit(salt), *cols)) for salt in (1, 2)]
    return df.withColumn(name, F.concat(*[F.lpad(h, 16, "0") for h in halves]))


def conform(df: DataFrame, strict: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 15 features in model order as doubles, plus ``keep``.

    A missing feature is an error when fitting (``strict``) and 0.0 when scoring.
    """
    missing = [f for f in FEATURES if f not in df.columns]
    if strict and missing:
        raise ValueError(f"missing features: {missing}")
    features = [F.lit(0.0).alias(f) if f in missing else F.col(f).cast("double").alias(f) for f in FEATURES]
    return df.select(*[k for k in keep if k in df.columns], *features)


def model_types(df: DataFrame) -> DataFrame:
    """Round fractional features to single precision, the width the narrowed columns have at fit time.

    Whole numbers narrow to integer types and stay exact, also beyond 2^24; every feature is read as a double, so the
    values decide and not the type.
    """
    rounded = [f.name for f in df.schema.fields if f.name in FEATURES and isinstance(f.dataType, FLOATS)]
    return df.withColumns({c: F.when(F.col(c) == F.rint(c), F.col(c)).otherwise(float32_round(F.col(c))) for c in rounded})


def downsize(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Narrowest type per numeric column: one row each with its range and the chosen type.

    Bounds are strict: an integer column that reaches 127 no longer fits int8.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    fields = [f for f in fields if isinstance(f.dataType, INTEGERS + FLOATS)]
    bounds = df.agg(*[fn(f"`{f.name}`").cast("double").alias(f"{tag}{i}")
                      for i, f in enumerate(fields) for tag, fn in (("lo", F.min), ("hi", F.max))])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(isinstance(f.dataType, INTEGERS)).alias("whole"),
                 F.lit(f.dataType.simpleString()).alias("current"),
                 F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"))
        for i, f in enumerate(fields)])
    inside = lambda bits: (F.col("lo") > -(2.0 ** (bits - 1))) & (F.col("hi") < 2.0 ** (bits - 1) - 1)
    # Largest magnitude of a single-precision float.
    single = 3.4028234663852886e38
    chosen = (F.when(F.col("whole") & inside(8), "int8").when(F.col("whole") & inside(16), "int16")
              .when(F.col("whole") & inside(32), "int32").when(F.col("whole"), "int64")
              .when((F.col("lo") > -single) & (F.col("hi") < single), "float32").otherwise("float64"))
    return bounds.select(F.inline(rows)).select("column", "current", "lo", "hi", chosen.alias("chosen"))


# Spark type for each chosen width.
SPARK_TYPES = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint",
               "float32": "float", "float64": "double"}


def apply_downsize(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Cast the columns to the types `downsize` advises (one row per column is read back)."""
    advice = {row["column"]: SPARK_TYPES[row["chosen"]] for row in downsize(df, columns).collect()}
    return df.select(*[F.col(f"`{c}`").cast(advice[c]).alias(c) if c in advice else F.col(f"`{c}`")
                       for c in df.columns])


def find_label(df: DataFrame) -> str | None:
    """First label column present, by exact name; None means the table can only be scored."""
    return next((name for name in LABEL_COLUMNS if name in df.columns), None)


def with_target(df: DataFrame, label: str | None = None, name: str = "y") -> DataFrame:
    """Add the binary target where the table has a label column, else return it unchanged."""
    label = label or find_label(df)
    return df if label is None else df.withColumn(name, binarize(F.col(f"`{label}`")))


def benign_only(df: DataFrame, target: str = "y") -> DataFrame:
    return df.where(F.col(target) == 0)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Concatenate by name; a column missing in one source is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per raw label, most frequent first."""
    return (df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "label"))


def align_xy(features: DataFrame, target: DataFrame, key: str = "row_id") -> DataFrame:
    """Bring an external score or label table to the flow rows, one to one by row id."""
    return features.join(target, key, "inner")
