"""URL filters: suffix rules, and logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import ascii_lower

# (block or allow, host, path) of the production rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased. Empty without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end. Empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Verdict and name of the longest rule that fits, null if none does. Of equally long ones the first."""
    ordered = sorted(rules, key=lambda rule: -len(rule[1] + rule[2]))
    chosen = F.lit(None).cast("struct<verdict: string, rule: string>")
    for verdict, rule_host, rule_path in reversed(ordered):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))
        chosen = F.when(fits, value).otherwise(chosen)
    return chosen


@dataclass(frozen=True)
class Model:
    """A weight for each hashed n-gram, and what is added to their sum."""

    weights: tuple[float, ...]
    bias: float
    sizes: tuple[int, ...]


def features(host: Column, path: Column, buckets: int, sizes: Sequence[int]) -> Column:
    """The distinct buckets of the character n-grams of ``^host`` and of ``path$``, told apart by their part."""

    def grams(text: Column, part: str, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
        made = F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(part), F.substr(text, i, F.lit(n))), F.lit(buckets)))
        return F.when(F.length(text) >= n, made).otherwise(F.array().cast("array<bigint>"))

    marked = ((F.concat(F.lit("^"), host), "h"), (F.concat(path, F.lit("$")), "p"))
    return F.array_distinct(F.concat(*[grams(text, part, n) for text, part in marked for n in sizes]))


def train(
    labelled: DataFrame,
    buckets: int = 4096,
    sizes: Sequence[int] = (3, 4),
    most_rows: int = 2000,
    rounds: int = 12,
    rate: float = 2.0,
    decay: float = 1e-4,
) -> Model:
    """Fits ``labelled`` (``url``, ``blocked`` 0 or 1) by gradient descent; each round is one aggregation.

    The fit uses at most ``most_rows`` labelled URLs: those whose hashes are smallest, so that the choice
    does not depend on the layout. URLs or labels that are null are passed over, repeated rows count
    once. Without any labelled row all weights are 0. What reaches the driver are the weights.
    """
    rows = labelled.select("url", F.col("blocked").cast("double").alias("y")).dropna().distinct()
    order = F.xxhash64("url")
    few = rows.orderBy(order, "url", "y").limit(most_rows)
    few = few.select("y", features(host(F.col("url")), path(F.col("url")), buckets, sizes).alias("f"))
    few = few.repartition(1).cache()  # bounded by most_rows
    n = few.count()
    weights, bias = [0.0] * buckets, 0.0
    for _ in range(rounds if n else 0):
        error = few.select("f", (F.col("y") - _probability(F.col("f"), weights, bias)).alias("e"))
        per_row = F.col("e") / F.greatest(F.size("f"), F.lit(1))
        sums = error.select(F.explode(F.concat("f", F.array(F.lit(-1).cast("bigint")))).alias("b"), per_row.alias("g"), "e")
        for r in sums.groupBy("b").agg(F.sum("g").alias("g"), F.sum("e").alias("e")).collect():
            if r["b"] < 0:
                bias += rate * r["e"] / n
            else:
                weights[r["b"]] += rate * buckets**0.5 * r["g"] / n
        weights = [w * (1 - decay) for w in weights]
    few.unpersist()
    return Model(tuple(weights), bias, tuple(sizes))


def _probability(found: Column, weights: Sequence[float], bias: float) -> Column:
    """Of being blocked: the weights of the n-grams, averaged, plus the bias, through the logistic function."""
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to a constant
    total = F.aggregate(found, F.lit(0.0), lambda a, b: a + F.element_at(table, (b + 1).cast("int")))
    mean = total / F.greatest(F.size(found), F.lit(1))
    return 1 / (1 + F.exp(-(mean + F.lit(float(bias)))))


def judge(
    pages: DataFrame,
    model: Model,
    rules: Sequence[tuple[str, str, str]] = RULES,
    key: str = "page_id",
    url: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """Per page: host, path, the rule that fits (else null), the model's probability of block, the verdict.

    A fitting rule decides; elsewhere a probability of ``threshold`` or more blocks. A null URL, or one
    without ``://``, has an empty host and path and is judged by the model on those. Repeated rows and null keys
    get a row each. An empty table gives no rows; other columns are not looked at. No row is shuffled.
    """
    parts = pages.select(F.col(key).alias("_k"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    found = features(F.col("host"), F.col("path"), len(model.weights), model.sizes)
    rows = parts.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("score", _probability(found, model.weights, model.bias))
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return rows.select(
        F.col("_k").alias(key),
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", own).alias("verdict"),
        "score",
    )


def labelled_by_rules(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url") -> DataFrame:
    """URLs that a rule decides, as a labelled table."""
    rule = fitting_rule(host(F.col(url)), path(F.col(url)), rules)
    rows = pages.select(F.col(url).alias("url"), (rule["verdict"] == "block").cast("int").alias("blocked"))
    return rows.where("blocked IS NOT NULL")
