"""Joins that hold up when a side outgrows memory or one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_ROWS = 200_000
HOT_SHARE = 1000  # a key is hot when it holds more than 1/HOT_SHARE of the rows


def input_bytes(df: DataFrame) -> int:
    """Size of all the files and relations ``df`` reads, from metadata; no job runs.

    Filters, projections, groupings and joins to a unique key do not add rows, so for such a
    ``df`` this bounds the result where Catalyst's own estimate multiplies the join inputs.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    return input_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def fits(df: DataFrame, rows: int | None = None) -> bool:
    """Whether ``df`` has at most ``rows`` rows, by a count that stops beyond them."""
    rows = BROADCAST_ROWS if rows is None else rows
    return df.limit(rows + 1).count() <= rows


def hot_keys(rows: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``1/share`` of the rows: at most ``share`` of them.

    A frequent-items sketch of bounded size is merged from the map side, so the rows are not
    shuffled. Being a sketch it may misjudge keys near the limit; callers use it only to
    spread work and stay exact for any set of keys.
    """
    return (
        rows.where(F.col(key).isNotNull())
        .agg(F.expr(f"approx_top_k(`{key}`, {share}, {20 * share})").alias("top"),
             F.count("*").alias("total"))
        .select(F.explode("top").alias("t"), "total")
        .where(F.col("t.count") * share > F.col("total"))
        .select(F.col("t.item").alias(key)))


def salted_join(facts: DataFrame, other: DataFrame, key: str, how: str = "inner",
                keys_from: DataFrame | None = None, share: int = HOT_SHARE) -> DataFrame:
    """``facts.join(other, key, how)`` by shuffle, with the rows of hot keys spread out.

    Rows of a hot key get a salt from their content and the partition they come from, one of as
    many as there are shuffle partitions, so that equal rows spread as well; the matching rows of
    ``other`` are repeated once per salt. Rows without a key match nothing; inner and semi joins
    drop them before the shuffle, the others spread them too. All other rows have salt 0. ``how`` is inner, left, left_semi or left_anti. ``keys_from`` is where hot keys
    are looked for when reading ``facts`` itself twice would be costly.
    """
    salts = max(2, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = F.broadcast(hot_keys(facts if keys_from is None else keys_from, key, share)
                      .withColumn("_hot", F.lit(True)))
    if how in ("inner", "left_semi"):
        facts = facts.where(F.col(key).isNotNull())
    content = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in facts.columns])
    spread = facts.join(hot, key, "left").withColumn("_salt", F.when(
        F.col("_hot") | F.col(key).isNull(), F.pmod(content, F.lit(salts)).cast("int")).otherwise(0))
    repeated = other.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                           .otherwise(F.array(F.lit(0)))))
    return spread.drop("_hot").join(repeated.drop("_hot"), [key, "_salt"], how).drop("_salt")


def lookup(facts: DataFrame, other: DataFrame, key: str, how: str = "inner",
           keys_from: DataFrame | None = None, limit: int | None = None,
           measure: bool = False, unique: bool = False) -> DataFrame:
    """Join that broadcasts ``other`` only behind a check of its size, else ``salted_join``.

    ``other`` must be derived by operations that add no rows to its inputs. The size of the
    inputs knows nothing of filters, so with ``measure`` an ``other`` with large inputs is
    counted, up to the row bound, before the facts are shuffled for it. That pays for master
    tables cut down to a few rows. Where the key is ``unique`` among the facts there is
    nothing to spread, and a plain shuffle join is used.
    """
    if is_small(other, limit) or (measure and fits(other)):
        return facts.join(F.broadcast(other), key, how)
    if unique:
        return facts.join(other, key, how)
    return salted_join(facts, other, key, how, keys_from)
