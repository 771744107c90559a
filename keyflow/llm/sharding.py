"""Sharding by rendezvous hashing over weighted shards."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import written

# Rows numbered together in one task; the rest of a shard is numbered elsewhere at the same time.
ROWS_PER_CHUNK = 100_000


def _score(key: Column, shard: int, weight: float) -> Column:
    """Minus the weighted logarithm of a uniform value in (0, 1) that key and shard alone decide. Smallest wins."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / F.lit(2.0**53)
    return -F.log(uniform) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float], shards: Sequence[int] | None = None) -> Column:
    """The shard of each key, chosen by the key and the list of shards alone.

    A shard gets keys in proportion to its weight. Adding a shard moves keys only into it, taking one
    away moves only its own keys. ``shards`` names the shards (0, 1, ... by default); a name keeps its
    keys wherever it stands in the list. A null key counts as a key of its own. Equal scores go to the
    shard with the smaller name.
    """
    names = list(range(len(weights))) if shards is None else list(shards)
    if not names or len(names) != len(weights) or len(set(names)) != len(names):
        raise ValueError("one positive weight is needed for each of the differently named shards")
    if any(not (w > 0 and math.isfinite(w)) for w in weights):
        raise ValueError("weights must be positive numbers")
    bids = [F.struct(_score(key, s, w).alias("score"), F.lit(s).alias("shard")) for s, w in zip(names, weights)]
    return (F.least(*bids) if len(bids) > 1 else bids[0])["shard"]


def grown(key: Column, weights: Sequence[float], extra: float = 1.0) -> Column:
    """The shard of each key once a further shard of weight ``extra`` is there."""
    return rendezvous(key, [*weights, extra])


def assign(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    weights: Sequence[float] = (1.0,) * 40,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Each row's shard and its place there.

    Returns key, ``size`` (UTF-8 bytes of the text plus 16; null text: 16), ``text_crc32`` (of a null
    text: of no bytes, 0), ``law`` (``key``), ``shard``, ``slot`` (0, 1, ... without gaps in each shard)
    and ``grown_shard`` (the shard if one more of weight 1 is added). Repeated rows share a shard and get
    slots of their own. An empty table gives no rows. Other columns are not looked at.

    No task numbers a whole shard: a shard's rows are cut into chunks by where they were read, chunks
    are numbered side by side and start after the rows of the chunks before. The rows without texts are
    written once, so that chunk sizes and slots are taken from the same chunks even if tasks run again.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    bids = rendezvous(F.col("_k"), weights)
    rows = df.select(
        F.col(key).alias("_k"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_at"),
    )
    position = F.col("_at").bitwiseAND((1 << 33) - 1)
    chunk = F.struct(
        F.shiftright("_at", 33).cast("int").alias("task"), (position / rows_per_chunk).cast("long").alias("part")
    )
    placed = written(
        rows.select(
            "_k",
            "size",
            "text_crc32",
            bids.alias("shard"),
            grown(F.col("_k"), weights).alias("grown_shard"),
            chunk.alias("_chunk"),
        ),
        "shards",
    )
    by_shard = "PARTITION BY shard ORDER BY _chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    starts = placed.groupBy("shard", "_chunk").agg(F.count("*").alias("_n"))
    starts = starts.select("shard", "_chunk", F.expr(f"coalesce(sum(_n) OVER ({by_shard}), 0L)").alias("_start"))
    inside = F.expr("row_number() OVER (PARTITION BY shard, _chunk ORDER BY _k, text_crc32, size)")
    return (
        placed.join(starts, ["shard", "_chunk"])
        .withColumn("slot", (F.col("_start") + inside - 1).cast("long"))
        .select(
            F.col("_k").alias(key),
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            "slot",
            "grown_shard",
        )
    )
