"""Importance resampling towards a target: hashed n-gram buckets, gains per bucket, a draw without replacement."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.llm.common import LOWER, UPPER, written
from keyflow.operators.distribute import global_sequence

# Fixed value: a word is a run of characters that are neither ASCII control, blank, punctuation nor capitals.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Stretches between blanks whose words a task keeps; longer ones are cut into words each time they occur.
CACHED_STRETCHES = 200_000
LONGEST_CACHED = 64

Spans = list[tuple[str, tuple[int, int]]]


# Capitals to small letters, and white space to blanks, byte by byte: neither changes where words are.
_PLAIN = bytes.maketrans(UPPER.encode() + b"\t\n\v\f\r", LOWER.encode() + b" " * 5)


class Words:
    """Words of texts, with their places, by an untrained split of the lower-cased text.

    White space is never part of a word, so the split is made for each stretch between blanks, and kept for the
    stretches that come again.
    """

    def __init__(self):
        from tokenizers import Regex, pre_tokenizers

        self._split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        self._known: dict[str, Spans] = {}

    def stretches(self, text: str) -> list[str]:
        return text.encode().translate(_PLAIN).decode().split(" ")

    def cut(self, part: str) -> Spans:
        """The words of a stretch, and where each starts and ends in it."""
        return self._split.pre_tokenize_str(part)

    def __call__(self, text: str) -> Spans:
        """The words of a whole text, and where each starts and ends in it."""
        out, at = [], 0
        for part in self.stretches(text):
            found = self._known.get(part)
            if found is None:
                found = kept(self._known, part, self.cut(part))
            out += [(word, (at + a, at + b)) for word, (a, b) in found]
            at += len(part) + 1
        return out


def kept[V](known: dict[str, V], part: str, value: V) -> V:
    """Keeps what was found for a stretch, unless it is long; when too much is kept, it starts afresh."""
    if len(part) <= LONGEST_CACHED:
        if len(known) >= CACHED_STRETCHES:
            known.clear()
        known[part] = value
    return value


def windows(spans: Spans, n: int) -> Iterator[tuple[str, tuple[int, int]]]:
    """The runs of ``n`` consecutive words, joined by one blank, and where each starts and ends."""
    for at in range(len(spans) - n + 1):
        run = spans[at : at + n]
        yield " ".join(word for word, _ in run), (run[0][1][0], run[-1][1][1])


class Buckets:
    """The buckets of a text's features: all runs of ``least`` to ``most`` words, joined by one blank."""

    def __init__(self, least: int, most: int, buckets: int):
        self._words, self._least, self._most, self._buckets = Words(), least, most, buckets
        self._known: dict[str, tuple[int, ...]] = {}

    def _of(self, feature: str) -> int:
        return zlib.crc32(feature.encode()) % self._buckets

    def __call__(self, text: str) -> tuple[int, dict[int, int]]:
        """How many words there are, and how often each bucket is met."""
        counts: defaultdict[int, int] = defaultdict(int)
        n_words, known = 0, self._known
        for part, times in Counter(self._words.stretches(text)).items():
            single = known.get(part)
            if single is None:
                single = kept(known, part, tuple(self._of(word) for word, _ in self._words.cut(part)))
            n_words += times * len(single)
            if self._least == 1:
                for bucket in single:
                    counts[bucket] += times
        if self._most > 1:
            spans = self._words(text)
            for n in range(max(2, self._least), self._most + 1):
                for feature, _ in windows(spans, n):
                    counts[self._of(feature)] += 1
        return n_words, counts


def _bucketed(df: DataFrame, text: str, least: int, most: int, buckets: int, keep: list[str]) -> DataFrame:
    """``keep`` and, of each text, its words, its features, and its buckets with their counts as packed numbers."""
    schema = T.StructType([df.schema[n] for n in keep])
    schema = schema.add("n_words", T.LongType()).add("n_features", T.LongType()).add("packed", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Buckets(least, most, buckets)
        for batch in batches:
            made: list[tuple[int, int, bytes]] = []
            for body in batch.column(text):
                n_words, counts = features(body.as_py() or "")
                flat = np.array([*counts.keys(), *counts.values()], np.int64)
                made.append((n_words, int(flat[len(counts) :].sum()), _pack(flat)))
            columns = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            names = [*keep, "n_words", "n_features", "packed"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], *columns], names)

    return df.select(*keep, text).mapInArrow(run, schema)


def _pack(flat: np.ndarray) -> bytes:
    """Buckets, then counts, four bytes each (eight if one needs them; the first byte says which)."""
    narrow = not len(flat) or flat.max() < 2**32
    return bytes([4 if narrow else 8]) + flat.astype("<u4" if narrow else "<u8").tobytes()


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(packed, "<u4" if packed[0] == 4 else "<u8", offset=1).astype(np.int64)
    return flat[: len(flat) // 2], flat[len(flat) // 2 :]


def _histogram(bucketed: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket is met in all texts. Each task adds up its own; only one row a bucket reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                at, counts = _unpack(packed.as_py())
                total[at] += counts  # the buckets of a text differ
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    rows = bucketed.select("packed").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, floor(1000 ln) of its smoothed share of the target over that of the source."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    ratio = [((b + 1) * (s + n)) / ((a + 1) * (t + n)) for a, b in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(key: Column, seed: int) -> Column:
    """floor(1000 x Gumbel noise), which the key and the seed alone decide. A null key counts as empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    df: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    least: int = 1,
    most: int = 1,
    buckets: int = 10_000,
    min_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """Draws ``percent`` of the texts with ``min_words`` words or more, those most like the target the likeliest.

    Returns key, ``n_features`` (runs of ``least`` to ``most`` words, repeats counted), ``weight`` (the floored
    mean gain of its features' buckets; 0 without features), ``score`` (weight and noise of the key) and ``rank``
    (1, 2, ... by score, ties to the smaller key, null keys last, then by features and weight; null if not drawn).

    Null and empty texts have no features and are never drawn unless ``min_words`` is 0. Equal texts have equal weights, and repeated rows
    with one key equal scores. An empty table gives no rows; an empty target has a count of 0 in each bucket. Other
    columns are not looked at.

    Every text is cut into words once; its bucket counts are written, and all later steps read those. The number
    of buckets bounds what tasks and the driver hold.
    """
    if not (1 <= least <= most and buckets >= 1 and 0 <= percent <= 100):
        raise ValueError("runs of 1 or more words, at least one bucket and a percentage are needed")
    plain = df.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    counted = written(_bucketed(plain, "_t", least, most, buckets, ["_k"]), "buckets")
    wanted = _bucketed(target.select(F.col(target_text).alias("_t")), "_t", least, most, buckets, [])
    gain = gains(_histogram(counted, buckets), _histogram(wanted, buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for packed, n in zip(batch.column("packed"), batch.column("n_features").to_pylist()):
                at, counts = _unpack(packed.as_py())
                made.append(int((gain[at] * counts).sum()) // n if n else 0)
            kept = [batch.column(n) for n in ("_k", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(made, pa.int64())], ["_k", "n_words", "n_features", "weight"])

    kinds = T.StructType([counted.schema[n] for n in ("_k", "n_words", "n_features")]).add("weight", T.LongType())
    weighed = counted.mapInArrow(weigh, kinds)
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("_k"), seed))
    scored = written(scored.withColumn("_row", F.monotonically_increasing_id()), "scores")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    last = F.col("_k").isNull()
    order = able.select((-F.col("score")).alias("_down"), last.alias("_last"), "_k", "n_features", "weight", "_row")
    ranked = global_sequence(order, ["_down", "_last", "_k", "n_features", "weight", "_row"], "rank")
    ranked = ranked.where(F.col("rank") <= drawn).select(F.col("_row").alias("_at"), "rank")
    joined = scored.join(ranked, scored["_row"] == ranked["_at"], "left")
    return joined.select(F.col("_k").alias(key), "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
