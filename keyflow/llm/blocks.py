"""Asking, for very many hashed pieces of texts, how often each occurs in the corpus.

Texts are dealt out into blocks of some megabytes. A block sends each of its distinct hashes once, packed
into binary cells by parts of the hash range. A part counts what it gets and answers each cell with one
byte per hash, in the same order. The block works its hashes out again, in the same order, and so knows the answer for each
without any hash or text having been sent back. A hash that is everywhere costs four bytes per block.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
PART_HASHES = 1 << 20
LONG_TEXT = 64 << 10  # bytes; longer texts are blocks of their own
PARTITION_BYTES = 16 << 20
# Above this size of a corpus, blocks and parts grow with its root, so that cells stay well filled.
STEADY_BYTES = 100e9

CELL = "part int, block long, hashes binary, counts binary"
ANSWER = "block long, part int, answer binary"


@dataclass(frozen=True)
class Blocks:
    """``rows`` has ``block``, ``uid`` (tells rows apart), ``id`` and ``text``, dealt out by block.

    It stands several times in one plan, where Spark runs the exchange under it once.
    """

    rows: DataFrame
    total: int
    partitions: int

    def parts(self, bytes_per_hash: float, part_hashes: int = PART_HASHES) -> int:
        grown = max(1.0, math.sqrt(self.total / STEADY_BYTES))
        return max(self.partitions // 4, math.ceil(self.total / bytes_per_hash / (part_hashes * grown)), 1)


def blocks(df: DataFrame, key: Column, text: Column, block_bytes: int = BLOCK_BYTES) -> Blocks:
    """Deals texts out. Rows of a block were read one after the other; long texts stand alone."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    total, n = size["bytes"], max(size["n"], 1)
    grown = max(1.0, math.sqrt(total / STEADY_BYTES))
    per_block = max(1, int(block_bytes * grown * n / max(total, 1)))
    per_block = min(per_block, 1 << 20)
    cores = df.sparkSession.sparkContext.defaultParallelism
    partitions = max(2 * cores, math.ceil(total / (PARTITION_BYTES * grown)))
    rows = df.select(key.cast("long").alias("id"), text.alias("text"), F.monotonically_increasing_id().alias("uid"))
    place = F.col("uid").bitwiseAND((1 << 33) - 1)
    near = F.shiftright("uid", 33) * (1 << 31) + F.floor(place / per_block)
    block = F.when(F.octet_length("text") > LONG_TEXT, -1 - F.col("uid")).otherwise(near).cast("long")
    return Blocks(rows.select(block.alias("block"), "uid", "id", "text").repartition(partitions, "block"), total, partitions)


def in_order(group: pa.Table) -> pa.Table:
    return group.take(pa.array(np.argsort(group["uid"].to_numpy(), kind="stable")))


def cells(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (part, 32 further bits) of 64-bit hashes in order, as one number each; where each hash is; how many."""
    part = (hashes >> np.uint64(32)) % np.uint64(parts)
    return np.unique((part << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF)), return_inverse=True, return_counts=True)


def asked(grouped, hashes_of: Callable[[pa.Table], np.ndarray], parts: int) -> DataFrame:
    """The cells of each block. ``hashes_of`` gives a block's 64-bit hashes; one that stands there n times counts n."""

    def emit(key, group):
        distinct, _, counts = cells(hashes_of(in_order(group)), parts)
        part = (distinct >> np.uint64(32)).astype(np.int64)
        names, starts = np.unique(part, return_index=True)
        stops = [*starts[1:], len(part)]
        low, many = distinct.astype("<u4"), np.minimum(counts, 0xFFFFFFFF).astype("<u4")
        return pa.table(
            {
                "part": pa.array(names, pa.int32()),
                "block": pa.array(np.full(len(names), key[0].as_py(), np.int64)),
                "hashes": pa.array([low[s:e].tobytes() for s, e in zip(starts, stops)], pa.binary()),
                "counts": pa.array([_packed(many[s:e]) for s, e in zip(starts, stops)], pa.binary()),
            }
        )

    return grouped.applyInArrow(emit, CELL)


def _packed(counts: np.ndarray) -> bytes:
    """Nothing if all are 1, one byte each if they fit, else four."""
    most = counts.max(initial=1)
    return b"" if most == 1 else counts.astype(np.uint8).tobytes() if most < 256 else counts.tobytes()


def _unpacked(counts: bytes, n: int) -> np.ndarray:
    return np.ones(n, np.int64) if not counts else np.frombuffer(counts, np.uint8 if len(counts) == n else "<u4").astype(np.int64)


def level(count: np.ndarray) -> np.ndarray:
    """A byte that grows with the count: 0 for 1, then four steps each time the count doubles."""
    return np.minimum(255, np.floor(4 * np.log2(np.maximum(count, 1)))).astype(np.uint8)


def answered(asked: DataFrame) -> DataFrame:
    """The answers to cells: for each hash the level of its count."""

    def count(key, group):
        lists = [np.frombuffer(b.as_py(), "<u4") for b in group["hashes"]]
        counts = [_unpacked(c.as_py(), len(h)) for c, h in zip(group["counts"], lists)]
        sizes = np.cumsum([len(x) for x in lists])[:-1]
        everything, number = np.concatenate(lists), np.concatenate(counts)
        order = np.argsort(everything, kind="stable")
        ranked = everything[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        totals = np.add.reduceat(number[order], first)
        answer = np.empty(len(everything), np.uint8)
        answer[order] = np.repeat(level(totals), np.diff(np.append(first, len(ranked))))
        return pa.table(
            {
                "block": group["block"],
                "part": group["part"],
                "answer": pa.array([a.tobytes() for a in np.split(answer, sizes)], pa.binary()),
            }
        )

    return asked.groupBy("part").applyInArrow(count, ANSWER)


def understood(hashes: np.ndarray, parts: int, answers: pa.Table) -> np.ndarray:
    """The answer for each of a block's hashes, which must be those it was asked about."""
    distinct, inverse, _ = cells(hashes, parts)
    order = np.argsort(answers["part"].to_numpy(), kind="stable")
    joined = b"".join(answers["answer"][int(i)].as_py() for i in order)
    if len(joined) != len(distinct):
        raise ValueError(f"a block of {len(distinct)} hashes got {len(joined)} answers")
    return np.frombuffer(joined, np.uint8)[inverse]
