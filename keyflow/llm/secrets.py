"""Secret scans: candidates in whole texts, and how widely each value is owned."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.llm.common import ROW, numbered, written

# The kinds of secrets, in the order in which they are listed, and their patterns.
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OPAQUE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
LEAST_ASSIGNED = 6

HIT = "struct<kind: int, start: int, stop: int, hash: string>"
JUDGEMENT = "struct<start: int, kind: int, stop: int, owners: bigint, repositories: bigint, live: boolean>"
HITS, JUDGED = "_hits", "_judged"

_assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
_access, _hex, _opaque = re.compile(ACCESS), re.compile(HEX), re.compile(OPAQUE)


def entropy(value: str) -> float:
    """Bits per character."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def scan(text: str, least_entropy: float = 3.5) -> list[tuple[int, int, int, str]]:
    """Candidates of a text as (kind, start, end, value), by start and then by kind.

    The first three kinds are taken from the whole text, each without overlaps of its own. ``opaque``
    ones are long strings with letters, digits and enough entropy that touch none of the others.
    """
    found = [(0, *m.span(), m[2]) for m in _assign.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [(1, *m.span(), m[0]) for m in _access.finditer(text)]
    found += [(2, *m.span(), m[0]) for m in _hex.finditer(text)]
    taken = sorted(span[1:3] for span in found)
    reach, merged = -1, []
    for start, end in taken:
        if start > reach:
            merged.append([start, end])
        reach = max(reach, end)
        merged[-1][1] = reach
    k = 0
    for m in _opaque.finditer(text):
        while k < len(merged) and merged[k][1] <= m.start():
            k += 1
        if k < len(merged) and merged[k][0] < m.end():
            continue
        value = m[0]
        if re.search("[0-9]", value) and re.search("[A-Za-z]", value) and entropy(value) >= least_entropy:
            found.append((3, *m.span(), value))
    return sorted(found, key=lambda x: (x[1], x[0]))


def listed(hits: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in hits)


def candidates(df: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The rows of ``df`` with a column ``hits``: the candidates of the text, values as SHA-256 only.

    Unless ``keep_text`` is set the text itself is dropped.
    """
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("hash", pa.string())]))
    names = [n for n in df.columns if keep_text or n != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [
                [
                    {"kind": k, "start": s, "stop": e, "hash": hashlib.sha256(v.encode()).hexdigest()}
                    for k, s, e, v in scan(body.as_py() or "")
                ]
                for body in batch.column(text)
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(hits, kind)], [*names, HITS])

    schema = T.StructType([*[df.schema[n] for n in names], *T._parse_datatype_string(f"{HITS} array<{HIT}>").fields])
    return df.mapInArrow(run, schema)


def ownership(found: DataFrame) -> DataFrame:
    """Number of distinct owners and of distinct repositories of each candidate value.

    A document id is a repository, and its owner is the document's source. A null owner or id counts
    as one owner or repository. Repetitions are taken out before anything is shuffled, and a value is
    counted per owner first, so that no task gets all rows of a widely copied value.
    """
    seen = found.select("_id", F.coalesce("_owner", F.lit("")).alias("_owner"), F.explode(f"{HITS}.hash").alias("hash"))
    repositories = seen.groupBy("hash", "_owner", "_id").agg(F.lit(1).alias("_one"))
    by_owner = repositories.groupBy("hash", "_owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def classify(found: DataFrame, copied_owners: int = 3, copied_repositories: int = 100) -> DataFrame:
    """Adds to each document its candidates by start and kind, with their ownership and whether they look live.

    A value with ``copied_owners`` owners or more, or in ``copied_repositories`` repositories or more whoever
    owns them, is a widely copied example; any other is owner-specific and looks live.
    Values are matched by an ordinary join, in which Spark can split a frequent value, and documents
    are put together again by their row number.
    """
    apart = found.select(ROW, F.explode(HITS).alias("hit")).withColumn("hash", F.col("hit.hash"))
    live = (F.col("owners") < copied_owners) & (F.col("repositories") < copied_repositories)
    judged = F.struct("hit.start", "hit.kind", "hit.stop", "owners", "repositories", live.alias("live"))
    joined = apart.join(ownership(found), "hash").select(ROW, judged.alias("judged"))
    lists = joined.groupBy(ROW).agg(F.array_sort(F.collect_list("judged")).alias(JUDGED))
    none = F.array().cast(f"array<{JUDGEMENT}>")
    return found.join(lists, ROW, "left").withColumn(JUDGED, F.coalesce(JUDGED, none))


def digest(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    copied_owners: int = 3,
    copied_repositories: int = 100,
) -> DataFrame:
    """Per document: counts and digest of the base kinds, all spans, how many look live, and the widest ownership.

    Base spans stay whatever their ownership; opaque strings count only if their value is
    owner-specific. ``most_owners`` and ``most_repositories`` are those of the document's widest copied value, 0
    without candidates. A null text is an empty one. Repeated rows get a result each, and a null key its
    own row. An empty table gives no rows; other columns are not looked at.
    """
    rows = df.select(
        F.monotonically_increasing_id().alias(ROW),
        F.col(key).cast("long").alias("_id"),
        F.col(owner).cast("string").alias("_owner"),
        F.col(text).alias("_text"),
    )
    found = classify(written(candidates(rows, "_text"), "secrets"), copied_owners, copied_repositories)
    hits = F.col(JUDGED)
    base = F.filter(hits, lambda x: x["kind"] < 3)
    names = F.array(*[F.lit(k) for k in KINDS])
    span = lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["stop"].cast("string"))
    count = lambda test: F.size(F.filter(hits, test)).cast("long")
    most = lambda name: F.coalesce(F.array_max(hits[name]), F.lit(0)).cast("long")
    kept = F.filter(hits, lambda x: (x["kind"] < 3) | x["live"])
    return found.select(
        F.col("_id").alias(key),
        count(lambda x: x["kind"] == 0).alias("n_assign"),
        count(lambda x: x["kind"] == 1).alias("n_access"),
        count(lambda x: x["kind"] == 2).alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, span), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(kept, span), ",").alias("spans"),
        count(lambda x: x["live"]).alias("n_live"),
        count(lambda x: ~x["live"]).alias("n_copied"),
        most("owners").alias("most_owners"),
        most("repositories").alias("most_repositories"),
    )


def redact(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    size: str | None = None,
    copied_owners: int = 3,
    copied_repositories: int = 100,
    mark: str = "[secret]",
) -> DataFrame:
    """The rows of ``df`` with each owner-specific value replaced by ``mark``; widely copied examples stay.

    Of an assignment the name stays and its value goes. ``size`` names a column that holds the number of
    characters and is brought up to date. All columns and rows are kept, repeated rows too; a null text stays null, a
    null owner or key counts as one. Overlapping values become one mark. An empty table gives no rows.

    The table is numbered and written once together with its candidates. Only rows that have any take
    part in the joins.
    """
    names = list(df.columns)
    plain = [f"_c{i}" for i in range(len(names))]  # whatever the columns are called, nothing clashes
    body, doc, who = (plain[names.index(n)] for n in (text, key, owner))
    rows = written(candidates(numbered(df.toDF(*plain)), body, keep_text=True), "redact")
    suspect = rows.where(F.size(HITS) > 0)
    found = suspect.select(ROW, F.col(doc).alias("_id"), F.col(who).cast("string").alias("_owner"), HITS)
    live = F.filter(JUDGED, lambda x: x["live"])
    spans = F.transform(live, lambda x: F.struct(x["start"], x["stop"], x["kind"]))
    judged = classify(found, copied_owners, copied_repositories).select(ROW, spans.alias("_spans"))
    marked = suspect.join(judged, ROW).drop(ROW, HITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [
                replaced(value, [tuple(s.values()) for s in spans], mark) if spans else value
                for value, spans in zip(batch.column(body).to_pylist(), batch.column("_spans").to_pylist())
            ]
            columns = [pa.array(bodies, batch.column(n).type) if n == body else batch.column(n) for n in plain]
            yield pa.RecordBatch.from_arrays(columns, plain)

    changed = marked.select(*plain, "_spans").mapInArrow(run, df.toDF(*plain).schema)
    if size is not None:
        count = plain[names.index(size)]
        changed = changed.withColumn(count, F.length(body).cast(df.schema[size].dataType))
    return rows.where(F.size(HITS) == 0).select(*plain).unionByName(changed).toDF(*names)


def replaced(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """Replaces spans (start, end, kind) by the mark; overlapping ones by one mark."""
    out, at = [], 0
    for start, end, kind in spans:
        if kind == 0:
            m = _assign.match(text, start)
            start = m.start(2)
        if start > at or (start == 0 and at == 0):
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
