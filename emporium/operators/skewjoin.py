"""Equi-joins in which one key may hold any share of the left rows, without a task that gets all of them.

Frequent keys are found by a mergeable summary: every task keeps a bounded sketch of the key's most frequent values, sketches are
merged in two steps, and a key that holds more than ``1 / max_keys`` of the rows is always among those found. The rows of
hot keys are joined where they are, against a broadcast of the few right rows that match them; the
other rows take the usual shuffle. Which keys count as hot changes the plan, never the result. This does not lean
on runtime re-planning: AQE splits a hot partition only once its bytes have been shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Right rows of hot keys that are broadcast; more are dealt by a salt.
BROADCAST_ROWS = 100_000
SALTS = 64


def _frequent(df: DataFrame, keys: Sequence[str], max_keys: int) -> tuple[int, dict[str, list[tuple[object, int]]]]:
    """``(rows, key -> values with estimated counts)`` from one pass that serves all the keys."""
    room = 2 * max_keys  # of tracked values, so that the sketch's error stays below the share looked for
    some = df.groupBy((F.spark_partition_id() % 64).alias("some")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"approx_top_k_accumulate({k}, {room}) FILTER (WHERE {k} IS NOT NULL)").alias(f"sketch{i}")
          for i, k in enumerate(keys)])
    found = some.groupBy(F.col("some") < 0).agg(
        F.sum("rows").alias("rows"),
        *[F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch{i}, {room}), {max_keys})").alias(f"top{i}")
          for i, _ in enumerate(keys)]).first()
    if not found:
        return 0, {k: [] for k in keys}
    return found["rows"], {k: [(r["item"], r["count"]) for r in found[f"top{i}"] or [] if r["item"] is not None]
                           for i, k in enumerate(keys)}


def frequent_keys(df: DataFrame, key: str, max_keys: int = 1000) -> list[tuple[object, int]]:
    """Non-null values of ``key`` with their estimated counts, most frequent first: all that hold more than
    ``1 / max_keys`` of the rows are among them. At most ``max_keys`` come to the driver."""
    return _frequent(df, [key], max_keys)[1][key]


def hot_keys_of(df: DataFrame, keys: Sequence[str], partitions: int | None = None,
                max_keys: int = 1000) -> dict[str, list[object]]:
    """For each of ``keys`` its values that hold over half of an even partition of the shuffled rows; one pass for all."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total, top = _frequent(df, keys, max_keys)
    return {k: [v for v, n in top[k] if n * 2 * min(parts, max_keys) > total] for k in keys}


def hot_keys(df: DataFrame, key: str, partitions: int | None = None, max_keys: int = 1000) -> list[object]:
    """Keys that hold over half of an even partition of the shuffled rows."""
    return hot_keys_of(df, [key], partitions, max_keys)[key]


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot: list[object] | None = None) -> DataFrame:
    """``left.join(right, key, how)`` for ``how`` inner or left, with the hot keys of the left side apart.

    ``hot`` gives the keys; without it they are looked for here (a pass over the key column). Left rows
    without a key match nothing and are not shuffled at all."""
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how!r}")
    hot = hot_keys(left, key) if hot is None else hot
    keyed = left.where(F.col(key).isNotNull())
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    parts = [keyed.where(~is_hot).join(right, key, how)]
    if hot:
        few = right.where(is_hot)
        if few.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            parts.append(keyed.where(is_hot).join(F.broadcast(few), key, how))
        else:  # many rows on both sides: the right rows go to every salt, the left rows to one
            salt, salts = "__salt", F.sequence(F.lit(0), F.lit(SALTS - 1))
            dealt = keyed.where(is_hot).withColumn(salt, F.floor(F.rand() * SALTS).cast("int"))
            parts.append(dealt.join(few.withColumn(salt, F.explode(salts)), [key, salt], how).drop(salt))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if how == "left":
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name != key]
        out = out.unionByName(left.where(F.col(key).isNull()).select("*", *missing))
    return out
