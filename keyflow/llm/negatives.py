"""Hard negatives: per anchor its best positives, and for each the best others within a share of its score.

All rows are compared with all anchors, exactly, the way MAXIMUS does: anchors are clustered by angle; for a
cluster, candidates are sorted once by the most that any of its members can reach with them, and each member
walks that list until what is left cannot change its result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.llm.common import written
from keyflow.llm.vectors import best, finite, matrix
from keyflow.plans.spread import spread

# Rows whose list is sorted and walked at once.
ROWS_PER_BLOCK = 32_768
# Entries of a list that the members of a cluster look at in one step.
STRIDE = 512
# Bytes of anchors that tasks hold at once; more anchors are gone through in several passes over the rows.
ANCHOR_BYTES = 32_000_000
# Sums of whole numbers below this are exact in floats.
EXACT = 2.0**53
# More than angles and their cosines are rounded by.
ROUNDING = 1e-6
LARGEST = 2**63 - 1


# Set in the number of a row without a key, so that those come last among equals.
KEYLESS = 1 << 62


@dataclass
class Anchors:
    """Anchors of one pass, by rising cluster, and the scores that they look for."""

    row: np.ndarray
    key: np.ndarray
    label: np.ndarray
    vector: np.ndarray  # whole numbers
    cluster: np.ndarray
    centroids: np.ndarray
    low: np.ndarray  # anchors by searches: the lowest and the highest score that counts
    high: np.ndarray
    same: bool  # look for rows of the same label, or of another one
    k: int


class Search:
    """The best ``k`` rows of each search so far, from blocks that come one after the other."""

    def __init__(self, anchors: Anchors):
        self.a = anchors
        self.plain = anchors.vector.astype(np.float64)
        self.norm = np.linalg.norm(self.plain, axis=1)
        self.least = anchors.low.copy()  # what a further row must reach, in each search
        self.clusters = []
        cuts = np.flatnonzero(np.diff(anchors.cluster)) + 1
        for members in np.split(np.arange(len(anchors.cluster)), cuts):
            if len(members):
                centre = anchors.centroids[anchors.cluster[members[0]]]
                radius = _angles(self.plain[members], self.norm[members], centre).max()
                nothing = [np.zeros(0, np.int64)] * 4  # anchor, score, key, row
                self.clusters.append((members, centre, radius, [nothing] * self.least.shape[1]))
        self.looked_at = 0

    def block(self, row: np.ndarray, key: np.ndarray, label: np.ndarray, vector: np.ndarray) -> None:
        plain = vector.astype(np.float64)
        norm = np.linalg.norm(plain, axis=1)
        exact = self.norm.max(initial=0) * norm.max(initial=0) < EXACT
        for members, centre, radius, found in self.clusters:
            away = np.maximum(0, _angles(plain, norm, centre) - radius)
            reach = norm * (np.cos(away) + ROUNDING)
            order = np.argsort(-reach, kind="stable")
            for at in range(0, len(order), STRIDE):
                # A member goes on while a row with the next bound could still enter one of its searches.
                members = members[self.norm[members] * reach[order[at]] >= self.least[members].min(axis=1)]
                if not len(members):
                    break
                part = order[at : at + STRIDE]
                self.looked_at += len(members) * len(part)
                if exact:
                    scores = (self.plain[members] @ plain[part].T).astype(np.int64)
                else:  # of any size, then kept within 64 bits
                    wide = self.a.vector[members].astype(object) @ vector[part].T.astype(object)
                    scores = np.clip(wide, -LARGEST, LARGEST).astype(np.int64)
                fits = (self.a.label[members][:, None] == label[part]) == self.a.same
                fits &= self.a.row[members][:, None] != row[part]
                for j in range(len(found)):
                    ok = fits & (scores >= self.least[members, j, None]) & (scores <= self.a.high[members, j, None])
                    who, what = np.nonzero(ok)
                    if len(who):
                        new = (members[who], scores[who, what], key[part[what]], row[part[what]])
                        found[j] = self._first(j, [np.concatenate(x) for x in zip(found[j], new)])

    def _first(self, j: int, entries: list[np.ndarray]) -> list[np.ndarray]:
        """The first ``k`` entries of each anchor, which raise what a further row must reach."""
        kept = best(entries[0], entries[1], entries[2:], self.a.k)
        entries = [x[kept] for x in entries]
        who, start, n = np.unique(entries[0], return_index=True, return_counts=True)
        full = n == self.a.k
        self.least[who[full], j] = entries[1][start[full] + self.a.k - 1]
        return entries


def _angles(vectors: np.ndarray, norms: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ centre / np.maximum(norms, 1e-300), -1, 1))


def _searched(items: DataFrame, anchors: Anchors) -> DataFrame:
    """Per anchor and search, the first ``k`` of all rows: ``anchor``, ``anchor_id``, ``search``, ``score``, ``id``, ``row``."""
    sent = items.sparkSession.sparkContext.broadcast(anchors)
    width = anchors.vector.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(sent.value)
        for table in _blocks(batches):
            key = table["id"].fill_null(LARGEST).to_numpy()
            vector = matrix(table["vector"], width, np.int64)
            search.block(table["row"].to_numpy(), key, table["label"].to_numpy(), vector)
        for _, _, _, found in search.clusters:
            for j, (who, score, key, row) in enumerate(found):
                columns = [sent.value.row[who], sent.value.key[who], np.full(len(who), j, np.int32), score, key, row]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [n.split()[0] for n in kinds])

    kinds = ["anchor long", "anchor_id long", "search int", "score long", "id long", "row long"]
    each = items.mapInArrow(run, ", ".join(kinds))
    order = Window.partitionBy("anchor", "search").orderBy(F.desc("score"), "id", "row")
    return each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= anchors.k)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS_PER_BLOCK:
            yield pa.Table.from_batches(held)
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _centroids(sample: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Directions that a sample of anchors gathers around, about half the root of its size of them."""
    norms = np.linalg.norm(sample, axis=1, keepdims=True)
    units = sample[norms[:, 0] > 0] / norms[norms[:, 0] > 0]
    if not len(units):
        return np.zeros((1, sample.shape[1]))
    centres = units[:: max(1, len(units) // max(1, int(len(units) ** 0.5 / 2)))]
    for _ in range(rounds):
        nearest = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-300), centres)
    return centres


def _clustered(anchors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the direction that each anchor is nearest to."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest = np.argmax(matrix(batch.column("vector"), width) @ centroids.T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.int32())], [*batch.schema.names, "cluster"])

    return anchors.mapInArrow(run, T.StructType([*anchors.schema, T.StructField("cluster", T.IntegerType())]))


def _passes(clustered: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Adds the pass in which an anchor takes part. Clusters stay together, but for those above ``most`` anchors."""
    sizes = {r["cluster"]: r["count"] for r in clustered.groupBy("cluster").count().collect()}  # one row a centroid
    number, free = -1, 0
    which = F.lit(0)
    for cluster, size in sorted(sizes.items()):
        parts = -(-size // most)
        if parts > 1 or size > free:
            number, free = number + 1, most
        part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int") + number
        which = F.when(F.col("cluster") == cluster, part).otherwise(which)
        number, free = (number + parts - 1, 0) if parts > 1 else (number, free - size)
    return clustered.withColumn("pass", which), number + 1


def whole(vector: Column, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down to whole numbers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def mine(
    df: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 10,
    share: tuple[int, int] = (30, 90),
    scale: int = 256,
    anchor_bytes: int = ANCHOR_BYTES,
    most_sampled: int = 8192,
) -> DataFrame:
    """For each row for which ``anchor`` holds and each of its positives, the hardest negatives.

    A positive is one of the first ``positives`` other rows of the anchor's label; a negative one of the first
    ``negatives`` rows of other labels whose score is at least ``share[0]`` and at most ``share[1]`` hundredths of
    the positive's. The score is the inner product of whole components (see :func:`whole`); higher ones come first,
    ties by smaller key, null keys last. Returns ``anchor_id``, ``positive_id``, ``rank`` (1, 2, ... of each
    positive), ``negative_id``, ``positive_score``, ``negative_score``.

    Rows with a null label or vector, or a null or non-finite component, take no part. Shorter vectors count as
    continued by zeros. Repeated rows are rows of their own, as anchors, positives and negatives; a row is never
    its own positive. Where a positive's score is below 0 no score lies between the shares, so it has no negatives.
    Scores are exact and kept within 64 bits. No rows or no anchors give no rows; other columns are not looked at.

    Anchors are broadcast, ``anchor_bytes`` of them at a time; the rows are not shuffled. Directions of clusters are
    fitted on at most ``most_sampled`` anchors; they decide how far lists are walked, never the result.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = df.select(
        F.col(key).cast("long").alias("id"), label.alias("label"), F.col(vector).alias("vector"), anchor.alias("asks")
    )
    rows = rows.where(finite(F.col("vector")) & F.col("label").isNotNull())
    number = F.monotonically_increasing_id() + F.when(F.col("id").isNull(), F.lit(KEYLESS)).otherwise(F.lit(0))
    rows = rows.select("id", F.col("label").cast("long").alias("label"), whole(F.col("vector"), scale).alias("vector"), "asks")
    rows = written(spread(rows).withColumn("row", number), "items")
    items = rows.select("row", "id", "label", "vector")
    asking = rows.where(F.col("asks")).drop("asks")
    width, count = asking.agg(F.max(F.size("vector")), F.count("*")).first()
    width = max(width or 0, items.agg(F.max(F.size("vector"))).first()[0] or 0, 1)
    share_kept = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < F.lit((1 << 20) * min(1.0, most_sampled / max(count, 1)))
    sample = asking.where(share_kept).select("vector").limit(most_sampled).toArrow()
    centroids = _centroids(matrix(sample["vector"], width))
    placed, passes = _passes(written(_clustered(asking, centroids), "anchors"), max(1, anchor_bytes // (8 * width)))
    made = [_pass(items, placed.where(F.col("pass") == p), centroids, positives, negatives, share) for p in range(passes)]
    if not made:
        return items.sparkSession.createDataFrame([], RESULT)
    return reduce(DataFrame.unionByName, made)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _pass(
    items: DataFrame, asking: DataFrame, centroids: np.ndarray, positives: int, negatives: int, share: tuple[int, int]
) -> DataFrame:
    table = asking.toArrow().sort_by([("cluster", "ascending"), ("row", "ascending")])
    columns = {n: table[n].to_numpy() for n in ("row", "label", "cluster")}
    vectors = matrix(table["vector"], centroids.shape[1], np.int64)
    first = Anchors(
        row=columns["row"],
        key=table["id"].fill_null(LARGEST).to_numpy(),
        label=columns["label"],
        vector=vectors,
        cluster=columns["cluster"],
        centroids=centroids,
        low=np.full((len(vectors), 1), -LARGEST),
        high=np.full((len(vectors), 1), LARGEST),
        same=True,
        k=positives,
    )
    found = written(_searched(items, first), "positives")
    low, high = _ranges(found, first, positives, share)
    others = _searched(items, replace(first, low=low, high=high, same=False, k=negatives))
    others = others.select("anchor", F.col("search").alias("at"), "place", F.col("id").alias("other"),
                           F.col("row").alias("other_row"), F.col("score").alias("negative_score"))
    pairs = found.select("anchor", "anchor_id", F.col("place").alias("at"), "id", "row", F.col("score").alias("positive_score"))
    pairs = pairs.join(others.withColumn("at", F.col("at") + 1), ["anchor", "at"])
    named = lambda value, row: F.when(F.col(row) < KEYLESS, F.col(value))
    return pairs.select(
        named("anchor_id", "anchor").alias("anchor_id"),
        named("id", "row").alias("positive_id"),
        F.col("place").alias("rank"),
        named("other", "other_row").alias("negative_id"),
        "positive_score",
        "negative_score",
    )


def _ranges(found: DataFrame, anchors: Anchors, positives: int, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor and positive, the lowest and the highest score of a negative; where there is none, an empty range."""
    low = np.full((len(anchors.row), positives), LARGEST)
    high = np.full((len(anchors.row), positives), -LARGEST)
    number = {row: i for i, row in enumerate(anchors.row.tolist())}
    table = found.select("anchor", "place", "score").toArrow()  # a few numbers for each anchor of the pass
    for row, place, score in zip(*(table[n].to_pylist() for n in ("anchor", "place", "score"))):
        least, most = -(-share[0] * score // 100), share[1] * score // 100
        if least <= most:
            low[number[row], place - 1], high[number[row], place - 1] = least, most
    return low, high
