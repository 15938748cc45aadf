"""Exact-size sampling, balancing and splitting.

A sample keeps the n rows with the smallest draws, where a draw is a hash of the seed and the row's key.
Nothing is ranked as a whole: counts per leading hex digits of the draw (4,096 per group, combined before the
shuffle) locate the bucket the cut falls into, more digits are counted inside it while it is too large for one
task, and only the last bucket is ranked. The sample is then a plain comparison with the cut of the row's group.
The rows themselves are never shuffled, so a group that holds most of the data costs no more than the rest. Keys
must be unique in their group.

Each operator names itself in the seed of its draws: were balancing and splitting to share draws, the rows that
survive the first would all land on one side of the second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import draw
from ..schema import SEED, TEST_FRACTION, TRAIN_CAP
from ..session import attach_table, bounded_table, discard, materialize

_MAX_DRAW = "g"          # sorts after every hex digit
PREFIX = 3               # hex digits per counting step
RANKED_ROWS = 2_000_000  # rows one task may rank


def _cuts(df: DataFrame, group: str, sizes: Column, ranked_rows: int) -> DataFrame:
    """Largest kept draw per group, from the group and ``_draw`` columns of ``df``.

    ``df`` is read twice: to count prefixes, and to write the rows of the buckets that hold a cut, about one in 4,096.
    """
    plan, digits = _split_buckets(df, group, sizes, PREFIX), PREFIX
    fixed, ranked, wide = _sorted_out(plan, ranked_rows)
    if ranked.isEmpty() and wide.isEmpty():
        return fixed.select(group, F.col("_fixed").alias("_cut"))
    at_cut = attach_table(df.select(group, "_draw"), ranked.unionByName(wide), [group], "inner").where(F.col("_draw").startswith(F.col("_prefix")))
    near = materialize(at_cut.select(group, "_draw"), "draws")
    while digits < 32 and not wide.isEmpty():
        # Too many rows of these groups share the prefix to rank them in one task: look at more digits of those rows only.
        digits += PREFIX
        at_cut = attach_table(near, wide, [group], "inner").where(F.col("_draw").startswith(F.col("_prefix")))
        finer = _split_buckets(at_cut.select(group, "_draw", "_need"), group, F.col("_need"), digits, "_need")
        more_fixed, more_ranked, wide = _sorted_out(finer, ranked_rows)
        fixed, ranked = fixed.unionByName(more_fixed), ranked.unionByName(more_ranked)
    at_cut = (attach_table(near, ranked.unionByName(wide), [group], "inner")
              .where(F.col("_draw").startswith(F.col("_prefix")))
              .withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy("_draw"))))
    found = at_cut.where(F.col("_rank") == F.col("_need")).select(group, F.col("_draw").alias("_cut"))
    cuts = bounded_table(found.unionByName(fixed.select(group, F.col("_fixed").alias("_cut"))))
    discard(near)
    return cuts


def _sorted_out(plan: DataFrame, ranked_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups with a fixed cut, with a bucket one task may rank, and with a bucket that is too large for that."""
    small = F.col("_rows") <= ranked_rows
    return (plan.where("_fixed IS NOT NULL"), plan.where(F.col("_fixed").isNull() & small),
            plan.where(F.col("_fixed").isNull() & ~small))


def _split_buckets(df: DataFrame, group: str, sizes: Column, digits: int, *carried: str) -> DataFrame:
    """One row per group: the prefix bucket its cut falls into, or the fixed cut of a group kept or dropped whole."""
    buckets = df.groupBy(group, *carried, F.substring("_draw", 1, digits).alias("_prefix")).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(group)
    sized = (buckets
             .withColumn("_upto", F.sum("_n").over(whole.orderBy("_prefix")))
             .withColumn("_total", F.sum("_n").over(whole))
             .withColumn("_size", sizes.cast("long")))
    split = (F.col("_size") > 0) & (F.col("_size") < F.col("_total"))
    here = F.when(split, (F.col("_upto") >= F.col("_size")) & (F.col("_upto") - F.col("_n") < F.col("_size"))) \
        .otherwise(F.col("_upto") == F.col("_total"))
    # A refined group whose bucket is needed in full keeps everything up to the end of its last sub-bucket.
    kept_whole = F.rpad("_prefix", 32, "g") if digits > PREFIX else F.lit(_MAX_DRAW)
    return bounded_table(sized.where(here).select(
        group, "_prefix", (F.col("_size") - F.col("_upto") + F.col("_n")).alias("_need"), F.col("_n").alias("_rows"),
        F.when(F.col("_size") <= 0, "").when(~split, kept_whole).alias("_fixed")))


def mark_n(df: DataFrame, sizes: Column | int, key: list[str], by: str | None = None, seed: int | str = SEED,
           name: str = "picked", ranked_rows: int | None = None) -> DataFrame:
    """Flag the sampled rows.

    ``sizes`` may use the group (``_group``) and its row count (``_total``). Smaller groups are kept whole.
    """
    group = "_group"
    tagged = (df.withColumn("_draw", draw(seed, *key))
              .withColumn(group, F.col(by) if by else F.lit(0)))
    wanted = sizes if isinstance(sizes, Column) else F.lit(int(sizes))
    limit = RANKED_ROWS if ranked_rows is None else ranked_rows
    cuts = _cuts(tagged.select(group, "_draw"), group, wanted, limit)    # the counting passes need no more than this
    return (attach_table(tagged, cuts, [group], "inner")
            .withColumn(name, F.col("_draw") <= F.col("_cut")).drop("_draw", "_cut", group))


def sample_n(df: DataFrame, sizes: Column | int, key: list[str], by: str | None = None,
             seed: int | str = SEED, ranked_rows: int | None = None) -> DataFrame:
    """Exactly min(n, rows) rows, of the whole table or of each group."""
    return mark_n(df, sizes, key, by, seed, ranked_rows=ranked_rows).where("picked").drop("picked")


def class_counts(df: DataFrame, target: str = "y") -> tuple[int, int]:
    """(benign, attack) row counts."""
    counts = df.agg(F.count_if(F.col(target) == 0).alias("benign"), F.count_if(F.col(target) == 1).alias("attack"))
    return tuple(counts.first())


def undersample(df: DataFrame, key: list[str], ratio: float = 1.0, seed: int = SEED, target: str = "y",
                strategy: str = "undersample") -> DataFrame:
    """Thin the benign rows to ``int(attacks * ratio)`` when they outnumber the attacks; never oversample."""
    benign, attack = class_counts(df, target)
    if strategy != "undersample" or benign <= attack:
        return df
    wanted = int(attack * ratio)
    if wanted > benign:
        raise ValueError(f"ratio {ratio} asks for {wanted} benign rows, only {benign} exist")
    return sample_n(df, F.when(F.col("_group") == 0, wanted).otherwise(attack), key, target, f"{seed}:balance")


def stratified_cap(df: DataFrame, cap: int = TRAIN_CAP, key: list[str] = ("row_id",), seed: int = SEED,
                   target: str = "y") -> DataFrame:
    """At most ``cap // 2`` rows per class, applied only to tables with more than ``cap`` rows.

    A class with fewer rows is kept whole.
    """
    if sum(class_counts(df, target)) <= cap:
        return df
    return sample_n(df, cap // 2, list(key), target, f"{seed}:cap")


def class_sample(df: DataFrame, n: int = 150, key: list[str] = ("row_id",), seed: int = SEED,
                 target: str = "y") -> DataFrame:
    """At most ``n`` rows of each class."""
    return sample_n(df, n, list(key), target, f"{seed}:class")


def mark_test(df: DataFrame, fraction: float = TEST_FRACTION, key: list[str] = ("row_id",),
              seed: int = SEED) -> DataFrame:
    """Flag ``is_test`` on exactly ceil(fraction * rows) rows."""
    return mark_n(df, F.ceil(F.lit(fraction) * F.col("_total")), list(key), None, f"{seed}:split", "is_test")


def train_test_split(df: DataFrame, fraction: float = TEST_FRACTION, key: list[str] = ("row_id",),
                     seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test), disjoint and together the whole table."""
    marked = mark_test(df, fraction, key, seed)
    return marked.where("NOT is_test").drop("is_test"), marked.where("is_test").drop("is_test")


def shuffle(df: DataFrame, key: list[str], seed: int = SEED) -> DataFrame:
    """Random permutation as a range-partitioned sort by draw.

    No operator here depends on row order; use it for exports whose readers do.
    """
    return df.orderBy(draw(f"{seed}:shuffle", *key), *key)
