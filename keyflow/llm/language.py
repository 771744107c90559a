"""Language identification by unigram pieces, summed over all segmentations of each word."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDETERMINED = "und"

# Stands before each word, as in the vocabulary.
START = "▁"
# Probabilities of words up to this length are multiplied as they are, those of longer ones as logarithms, to stay in range.
PLAIN = 32
# Probability of a letter that is not in the vocabulary, whatever the language.
UNSEEN = 1e-7
# Words whose scores a task keeps; beyond that it starts afresh.
CACHED_WORDS = 300_000

_letters = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    """Lower-cased runs of letters, however long."""
    return _letters.findall(text.lower())


def vocabulary(path: str) -> list[str]:
    """The pieces of a public vocabulary: lower-case letters, with or without the word start before them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(len(model)) if not (model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i))]
    pieces = {model.IdToPiece(i) for i in plain}
    shaped = re.compile(f"{START}?[^\\W\\d_]*")
    return sorted(p for p in pieces if p and p == p.lower() and shaped.fullmatch(p))


class Lattice:
    """All segmentations of words into pieces, for many words at once."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.n = len(pieces)

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def arcs(self, found: list[str]) -> Iterator[tuple[np.ndarray, list[tuple[int, int, np.ndarray]]]]:
        """For words of one length each, up to ``PLAIN``: which words, and (start, end, piece of each) for every stretch.

        The piece is ``n`` for a single unknown character and ``n + 1`` where a stretch is no piece.
        """
        lengths = np.array([len(w) for w in found], np.int64)
        for length in np.unique(lengths[lengths <= PLAIN]):
            which = np.flatnonzero(lengths == length)
            for at in range(0, len(which), 20_000):
                part = which[at : at + 20_000]
                joined = "".join(START + found[i] for i in part)
                codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").reshape(len(part), length + 1).astype(np.uint64)
                out = []
                for start in range(length + 1):
                    h = np.zeros(len(part), np.uint64)
                    for end in range(start + 1, min(length + 1, start + self.longest) + 1):
                        with np.errstate(over="ignore"):
                            h = h * _BASE + codes[:, end - 1] + np.uint64(1)
                        place = np.minimum(np.searchsorted(self.hashes, h), max(self.n - 1, 0))
                        known = self.hashes[place] == h if self.n else np.zeros(len(part), bool)
                        none = self.n if end == start + 1 else self.n + 1
                        piece = np.where(known, self.order[place] if self.n else none, none)
                        if end == start + 1 or known.any():
                            out.append((start, end, piece))
                yield part, out

    def _arcs_of(self, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and piece of every stretch of one long word that is a piece or a single character, by end."""
        codes = np.frombuffer((START + word).encode("utf-32-le"), "<u4").astype(np.uint64)
        h, out = np.zeros(len(codes), np.uint64), []
        for size in range(1, min(self.longest, len(codes)) + 1):
            n = len(codes) - size + 1
            with np.errstate(over="ignore"):
                h = h[:n] * _BASE + codes[size - 1 :] + np.uint64(1)
            place = np.minimum(np.searchsorted(self.hashes, h), max(self.n - 1, 0))
            known = self.hashes[place] == h if self.n else np.zeros(n, bool)
            at = np.arange(n) if size == 1 else np.flatnonzero(known)
            piece = np.where(known, self.order[place] if self.n else self.n, self.n)
            out.append((at, at + size, piece[at]))
        start, end, piece = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(end, kind="stable")
        return start[order], end[order], piece[order]

    def _forward(self, start: np.ndarray, end: np.ndarray, piece: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """Logarithms of what the segmentations up to each place of a long word add up to."""
        out = np.full((end[-1] + 1, logs.shape[1]), -np.inf)
        out[0] = 0
        first = np.searchsorted(end, np.arange(1, end[-1] + 2))
        for at in range(1, len(out)):
            here = slice(first[at - 1], first[at])
            out[at] = _log_sum(out[start[here]] + logs[piece[here]])
        return out

    def table(self, probabilities: np.ndarray) -> np.ndarray:
        """Probabilities with a row for unknown characters and one for stretches that are no piece."""
        columns = probabilities.shape[1]
        return np.vstack([probabilities, np.full((1, columns), UNSEEN), np.zeros((1, columns))])

    def log_likelihood(self, found: list[str], probabilities: np.ndarray) -> np.ndarray:
        """Of each word (rows) under each language (columns), by the forward algorithm."""
        table = self.table(probabilities)
        out = np.zeros((len(found), probabilities.shape[1]))
        with np.errstate(divide="ignore"):
            logs = np.log(table)
        for i, word in enumerate(found):
            if len(word) > PLAIN:
                out[i] = self._forward(*self._arcs_of(word), logs)[-1]
        for part, arcs in self.arcs(found):
            forward = np.zeros((max(e for _, e, _ in arcs) + 1, len(part), table.shape[1]))
            forward[0] = 1
            for start, end, piece in arcs:  # by start, so forward[start] is complete
                forward[end] += forward[start] * table[piece]
            out[part] = np.log(forward[-1])
        return out

    def expected(self, found: list[str], weights: np.ndarray, probabilities: np.ndarray) -> np.ndarray:
        """How often each piece is used in all segmentations of weighted words, each by its probability."""
        table = self.table(probabilities[:, None])[:, 0]
        counts = np.zeros(self.n + 2)
        with np.errstate(divide="ignore"):
            logs = np.log(table)[:, None]
        for i, word in enumerate(found):
            if len(word) > PLAIN:
                start, end, piece = self._arcs_of(word)
                forward = self._forward(start, end, piece, logs)[:, 0]
                last = len(word) + 1
                turned = np.argsort(last - start, kind="stable")  # the same word read from its end
                backward = self._forward((last - end)[turned], (last - start)[turned], piece[turned], logs)[::-1, 0]
                share = weights[i] * np.exp(forward[start] + logs[piece, 0] + backward[end] - forward[-1])
                counts += np.bincount(piece, share, self.n + 2)
        for part, arcs in self.arcs(found):
            size = max(e for _, e, _ in arcs) + 1
            forward, backward = np.zeros((size, len(part))), np.zeros((size, len(part)))
            forward[0] = backward[-1] = 1
            for start, end, piece in arcs:
                forward[end] += forward[start] * table[piece]
            for start, end, piece in reversed(arcs):
                backward[start] += table[piece] * backward[end]
            for start, end, piece in arcs:
                share = weights[part] * forward[start] * table[piece] * backward[end] / forward[-1]
                counts += np.bincount(piece, share, self.n + 2)
        return counts[: self.n]


def _log_sum(logs: np.ndarray) -> np.ndarray:
    top = logs.max(axis=0)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(logs - safe).sum(axis=0))


@dataclass(frozen=True)
class Model:
    pieces: tuple[str, ...]
    languages: tuple[str, ...]
    probabilities: np.ndarray  # pieces by languages


def held_out(key: Column) -> Column:
    """A quarter of the keys, by the checksum of their text."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    docs_per_language: int = 1000,
    words_per_language: int = 100_000,
    most_languages: int = 200,
    rounds: int = 3,
    smoothing: float = 0.1,
) -> Model:
    """Learns the piece probabilities of each language from documents that are not held out.

    The fit is bounded: the ``most_languages`` most frequent values of ``lang`` (a value beyond these is never
    predicted; the table of probabilities that every task holds grows with their number), of each about
    ``docs_per_language`` documents chosen by a hash of the key, and of those the ``words_per_language``
    most frequent words. Expectation-maximisation runs in one task per language. Rows without text or
    language are passed over. Without any row there are no languages. What reaches the driver is the
    number of documents per language and the probabilities of the pieces.
    """
    pieces = vocabulary(path)
    rows = df.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.col(lang).cast("string").alias("_l"))
    rows = rows.where(~held_out(F.col("_k")) & F.col("_l").isNotNull() & F.col("_t").isNotNull())
    sizes = rows.groupBy("_l").count().orderBy(F.desc("count"), "_l").limit(most_languages).collect()
    if not sizes:
        return Model(tuple(pieces), (), np.zeros((len(pieces), 0)))
    shares = F.lit(0.0)
    for r in sizes:
        share = min(1.0, docs_per_language / r["count"])
        shares = F.when(F.col("_l") == r["_l"], F.lit(share)).otherwise(shares)
    chosen = rows.where(F.pmod(F.xxhash64("_k"), F.lit(1 << 20)) < shares * (1 << 20))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.setdefault(name, Counter()).update(words(body.as_py()))
            flat = [(name, w, n) for name, c in counts.items() for w, n in c.items()]
            kinds = (pa.string(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in flat], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    counted = chosen.select("_l", "_t").mapInArrow(tally, "lang string, word string, n long")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    rank = F.expr("row_number() OVER (PARTITION BY lang ORDER BY n DESC, word)")
    counted = counted.withColumn("_rank", rank).where(F.col("_rank") <= words_per_language).drop("_rank")

    def fit(group: pa.Table) -> pa.Table:
        lattice = Lattice(pieces)
        found, weights = group["word"].to_pylist(), group["n"].to_numpy().astype(float)
        p = np.full(len(pieces), 1 / max(len(pieces), 1))
        for _ in range(rounds):
            p = lattice.expected(found, weights, p) + smoothing
            p /= p.sum()
        return pa.table({"lang": pa.array([group["lang"][0].as_py()]), "p": pa.array([p], pa.list_(pa.float64()))})

    fitted = counted.groupBy("lang").applyInArrow(fit, "lang string, p array<double>").orderBy("lang").collect()
    if not fitted:
        return Model(tuple(pieces), (), np.zeros((len(pieces), 0)))
    table = np.array([r["p"] for r in fitted]).T
    return Model(tuple(pieces), tuple(r["lang"] for r in fitted), table)


class Scorer:
    """Scores documents by the words in them, each word worked out once."""

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(list(model.pieces))
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        bags = [words(t) if t else [] for t in texts]
        wanted = set().union(*bags)
        missing = sorted(wanted - self.known.keys())
        if len(self.known) + len(missing) > CACHED_WORDS:
            self.known, self.scores, missing = {}, self.scores[:0], sorted(wanted)
        scores = self.lattice.log_likelihood(missing, self.model.probabilities)
        self.known.update(zip(missing, range(len(self.known), len(self.known) + len(missing))))
        self.scores = np.vstack([self.scores, scores])
        return [self._one(text, bag) for text, bag in zip(texts, bags)]

    def _one(self, text: str | None, bag: list[str]) -> tuple[str, float]:
        if not text or not self.model.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        at = np.fromiter((self.known[w] for w in bag), np.int64, len(bag))
        total = self.scores[at].sum(axis=0)
        best = int(np.argmax(total))
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def with_language(df: DataFrame, model: Model, text: str, into: tuple[str, str], keep_text: bool = True) -> DataFrame:
    """Adds the predicted language and its posterior probability, from the text alone."""
    names = [n for n in df.columns if keep_text or n != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for whole in batches:
            # A few hundred documents at a time bound the words that are held at once.
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                said = scorer(batch.column(text).to_pylist())
                made = [pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *made], [*names, *into])

    added = [T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())]
    return df.mapInArrow(run, T.StructType([*[df.schema[n] for n in names], *added]))


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, ``held_out``, ``lang_pred`` and ``score``.

    ``und`` with score 0 for a null text, one without letters, or a model without languages. Equal
    scores go to the language that is first in the alphabet. Repeated rows and null keys get a row
    each; a null key is not held out. An empty table gives no rows; other columns are not looked at.
    """
    rows = df.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    said = with_language(rows, model, "_t", ("lang_pred", "score"), keep_text=False)
    return said.select(F.col("_k").alias(key), held_out(F.col("_k")).alias("held_out"), "lang_pred", "score")


def recognised(df: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose language is determined with a posterior of ``least`` or more, as they are.

    Texts that are null, empty or without letters go. Repeated rows and null keys are judged each by its text, and all
    columns are kept. Equal posteriors go to the language that comes first. An empty table gives no rows.
    """
    plain = [f"_c{i}" for i in range(len(df.columns))]  # whatever the columns are called, nothing clashes
    body = plain[df.columns.index(text)]
    said = with_language(df.toDF(*plain), model, body, ("_lang", "_score"))
    sure = (F.col("_lang") != UNDETERMINED) & (F.col("_score") >= least)
    return said.where(sure).select(*plain).toDF(*df.columns)
