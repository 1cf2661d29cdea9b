"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of the MD5 that make a draw: 52 bits, exact in a double.
DIGITS = 13


def draw(key: Column, shard: int) -> Column:
    """A number strictly between 0 and 1, from the key's text and the shard alone."""
    text = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("\u0000null")), F.lit(str(shard)))
    return (F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the best draw for a key, where shard i wins in proportion to ``weights[i]``.

    The score of shard i is -log(draw) / weight, an exponential race that the smallest wins. A draw depends on the
    key and on i only: one more shard takes rows only into itself, and a shard of weight 0 has
    none. Equal keys go together; a null key is a key of its own. Ties take the lower shard.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    race = [F.struct((-F.log(draw(key, i)) / float(w)).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights) if w > 0]
    return (F.least(*race) if len(race) > 1 else race[0]).getField("shard")


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    """The rows with their shard, in place: no shuffle, any columns; an empty frame stays empty. ``name`` must be new."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {name} exists")
    return df.withColumn(name, shard_of(F.col(key), weights))


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str, name: str = "shard") -> None:
    """Write the rows below one folder per shard; every task writes its own files, so a large shard is no single task."""
    assign_shards(df, key, weights, name).write.partitionBy(name).mode("overwrite").parquet(path)
