"""Quality rules as weak supervision: rules vote or abstain, their accuracies are estimated from agreement."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import written

# White space between words, and the characters that count as symbols.
SPACE = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURED = "_id long, _chars long, _lines long, _upper long, _letters long, _ends long, _distinct long, _lettered long, " + ", ".join(
    f"{name} long" for name in COUNTS
)


_lettered = re.compile(rb"[^\x20\x09-\x0D]*[A-Za-z][^\x20\x09-\x0D]*")


def letters(text: str, raw: bytes, words: list[bytes]) -> tuple[int, int, int]:
    """Capitals, letters, and words with a letter, as Unicode has them, in a text of any length and script."""
    if text.isascii():  # the same, by bytes
        points = np.frombuffer(raw, np.uint8)
        upper = int(((points >= 65) & (points <= 90)).sum())
        return upper, upper + int(((points >= 97) & (points <= 122)).sum()), len(_lettered.findall(raw))
    characters = Counter(text)
    upper = sum(n for c, n in characters.items() if c.isupper())
    alpha = {c for c in characters if c.isalpha()}
    lettered = sum(n for w, n in Counter(words).items() if not alpha.isdisjoint(w.decode()))
    return upper, sum(characters[c] for c in alpha), lettered


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        j = first.setdefault(window, i)
        if j != i:
            covered[i : i + 3] = covered[j : j + 3] = b"\x01\x01\x01"
    return sum(covered)


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURED`` but the id."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # of bytes: at the six characters of SPACE, no others
    lines, seen, duplicates = 0, set(), 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            duplicates += line in seen
            seen.add(line)
    spaces = sum(text.count(c) for c in SPACE)
    upper, alpha, lettered = letters(text, raw, words)
    ends = sum(text.count(c) for c in ".!?")
    return (
        len(text),
        lines,
        upper,
        alpha,
        ends,
        len(set(words)),
        lettered,
        len(words),
        len(text) - spaces,
        sum(text.count(c) for c in SYMBOLS),
        duplicates,
        repeated_words(words),
    )


def measured(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of counts per document, the text left behind."""
    names = [part.split()[0] for part in MEASURED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(body.as_py()) for body in batch.column(1)]
            columns = [np.fromiter((r[i] for r in rows), np.int64, len(rows)) for i in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names)

    return df.select(F.col(key).cast("long").alias("_id"), F.col(text)).mapInArrow(run, MEASURED)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, good where ``good`` holds if that is given, else abstains."""

    name: str
    bad: Column
    good: Column | None = None


def rules() -> list[Rule]:
    """The rules on the counts of ``measured``. They look at different properties of a text.

    Most know one defect and abstain where it is missing, since that says little for a text.
    """

    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    repeats, symbols = share("n_repeat_words", "n_words"), share("n_symbols", "n_words")
    lines, capitals = share("n_dup_lines", "_lines"), share("_upper", "_letters")
    mean, ends = share("word_chars", "n_words"), share("_ends", "n_words")
    distinct, letters, lettered = share("_distinct", "n_words"), share("_letters", "_chars"), share("_lettered", "n_words")
    plain = (repeats <= 0.05) & (symbols <= 0.02) & (lines <= 0.1) & (letters >= 0.75) & (ends >= 0.01)
    return [
        Rule("repeats", repeats > 0.35),
        Rule("symbols", symbols > 0.1),
        Rule("lines", lines > 0.5),
        Rule("capitals", capitals > 0.3),
        Rule("word_length", (mean < 2.5) | (mean > 12)),
        Rule("distinct", distinct < 0.1),
        Rule("sentences", ends < 0.002),
        Rule("letters", letters < 0.65),
        Rule("lettered", lettered < 0.8),
        Rule("plain", F.lit(False), plain),
    ]


def votes(chosen: list[Rule]) -> Column:
    """The votes as text, one of ``+``, ``-``, ``0`` per rule."""
    never = F.lit(False)
    return F.concat(*[F.when(r.bad, "-").when(never if r.good is None else r.good, "+").otherwise("0") for r in chosen])


@dataclass(frozen=True)
class Model:
    """The share of good texts, and how often each rule is right when it votes. Abstaining says nothing."""

    prior: float
    accuracy: tuple[float, ...]

    def posterior(self, pattern: str) -> float:
        odds = math.log(self.prior / (1 - self.prior))
        for vote, right in zip(pattern, self.accuracy):
            odds += {"+": 1, "-": -1, "0": 0}[vote] * math.log(right / (1 - right))
        return 1 / (1 + math.exp(-odds))


def fit(patterns: list[tuple[str, int]], n_rules: int, rounds: int = 50, prior: float = 0.8, accuracy: float = 0.8) -> Model:
    """Expectation-maximisation over the counts of the vote patterns.

    Rules that vote alike on the same texts are taken to be right more often, those that stand alone
    less often. ``prior`` is the share of good texts, which agreement alone does not tell: it stays as
    given. Accuracies start from ``accuracy``, which also counts as ten votes, and stay between 0.55
    and 0.99, so that good and bad never change places.
    """
    model = Model(prior, (accuracy,) * n_rules)
    if not patterns:
        return model
    counts = np.array([n for _, n in patterns], float)
    cast = np.array([[{"+": 1, "-": -1, "0": 0}[v] for v in p] for p, _ in patterns])
    for _ in range(rounds):
        good = np.array([model.posterior(p) for p, _ in patterns])
        right = np.where(cast > 0, good[:, None], 1 - good[:, None]) * (cast != 0)
        estimates = (counts @ right + 10 * accuracy) / (counts @ (cast != 0) + 10)
        model = Model(prior, tuple(np.clip(estimates, 0.55, 0.99)))
    return model


def judge(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    chosen: list[Rule] | None = None,
    least: float = 0.5,
    least_words: int = 50,
    most_repeats: int = 50,
) -> DataFrame:
    """Per document: the counts, whether it fails the base rules, the posterior of good, the verdict.

    ``base_failed``: fewer than ``least_words`` words, or more than ``most_repeats`` per cent of the words
    in repeated windows. ``kept``: not failed, and the posterior is ``least`` or more. A null text has
    no words. Repeated rows and null keys get a row each. An empty table gives no rows; other columns
    are not looked at.

    Texts are measured where they are read. What reaches the driver are the counts of the vote
    patterns, at most three to the power of the number of rules.
    """
    chosen = rules() if chosen is None else chosen
    if not 1 <= len(chosen) <= 12:
        raise ValueError("between 1 and 12 rules, so that the vote patterns stay few")
    rows = written(measured(df, key, text), "quality").withColumn("votes", votes(chosen))
    patterns = rows.groupBy("votes").count().collect()
    model = fit([(r["votes"], r["count"]) for r in patterns], len(chosen))
    values = df.sparkSession.createDataFrame(
        [(r["votes"], model.posterior(r["votes"])) for r in patterns], "votes string, posterior double"
    )
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    return rows.join(F.broadcast(values), "votes").select(
        F.col("_id").alias(key),
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= least)).alias("kept"),
        "posterior",
        "votes",
    )
