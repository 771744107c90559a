"""Packing token sequences: vector best fit over tokens, documents and attention cost."""

from __future__ import annotations

import base64
import bisect
import heapq
import json
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import written

# Pieces packed together in one task. Each such block leaves about one sequence that is not full.
PIECES_PER_BLOCK = 200_000

PIECES = "_id long, _row long, piece int, start long, length long, ids_crc32 long"
PACKED = "_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence: tokens, pieces, and attention cost (sum of squared lengths).

    ``score`` picks among the open sequences that a piece fits into under every capacity: ``dot`` takes
    the largest weighted dot product of the piece with what is left, ``norm`` the smallest weighted
    norm of what would be left. Weights are those of tokens, pieces and attention.
    """

    tokens: int = 1024
    pieces: int = 1024  # as many as there are tokens, so that no sequence is lost to it
    attention: int = 1024 * 1024
    score: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)

    def __post_init__(self):
        if self.tokens < 1 or self.pieces < 1 or self.attention < self.tokens**2:
            raise ValueError("a full-length piece must fit into an empty sequence")
        if self.score not in ("dot", "norm"):
            raise ValueError(self.score)


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a tokenizers file and their ids. Only those found as they are written are supported."""
    with open(path, encoding="utf-8") as file:
        listed = json.load(file)["added_tokens"]
    for token in listed:
        if any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"an added token that is not matched literally: {token['content']!r}")
        if any(token is not other and token["content"] in other["content"] for other in listed):
            raise ValueError(f"an added token inside another: {token['content']!r}")
    return {token["content"]: token["id"] for token in listed}


def encoder(path: str, pattern: str, added: Mapping[str, int] = {}):
    """Encodes texts to ids by the vocabulary at ``path``, a file of base64 pieces with their ids.

    Where a token of ``added`` stands in a text it becomes its id; without any, all is plain text.
    """
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(added))
    return partial(getattr(own, "encode_to_numpy", own.encode), allowed_special="all")


def cut(length: int, most: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: all of full length but the first."""
    first = length % most or min(length, most)
    starts = [0, *range(first, length, most)]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], length])]


def pieces(
    df: DataFrame,
    path: str,
    pattern: str,
    end: int = 2,
    tokens: int = 1024,
    key: str = "doc_id",
    text: str = "text",
    added: Mapping[str, int] = {},
) -> DataFrame:
    """The pieces of all documents with the checksum of their ids. A null text is an empty one: its end id alone."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern, added)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["_id", "_row", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            out = [[] for _ in names]
            for doc, row, body in zip(*(batch.column(i) for i in range(3))):
                ids = np.append(np.asarray(encode(body.as_py() or ""), dtype="<u4"), np.uint32(end)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), tokens)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    for column, value in zip(out, (doc.as_py(), row.as_py(), k, start, length, crc)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    rows = df.select(F.col(key).cast("long"), F.monotonically_increasing_id(), F.col(text))
    return rows.mapInArrow(tokenize, PIECES)


def best_fit(lengths: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece, longest pieces first, and the number of sequences.

    Open sequences are kept by the tokens left, each such class as a heap on the norm of the pieces and
    attention left. From each class the first sequence with room under every capacity stands for the
    class; the score then decides between the classes.
    """
    tokens, most_pieces, most_attention = limits.tokens, limits.pieces, limits.attention
    w_tokens, w_pieces, w_attention = limits.weights
    dot = limits.score == "dot"
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    classes: list[list] = [[] for _ in range(tokens + 1)]
    open_left: list[int] = []  # sorted
    n = 0

    def first_fit(heap, cost):
        """The class's first sequence that takes the piece, removed from the heap."""
        skipped = []
        found = None
        while heap and found is None:
            entry = heapq.heappop(heap)
            if entry[2] >= 1 and entry[3] >= cost:
                found = entry
            else:
                skipped.append(entry)
        for entry in skipped:
            heapq.heappush(heap, entry)
        return found

    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        cost = length * length
        best = None
        for left in open_left[bisect.bisect_left(open_left, length) :]:
            rest = (left - length) / tokens
            if best and not dot and w_tokens * rest * rest >= best[0]:
                break
            entry = first_fit(classes[left], cost)
            if entry is None:
                continue
            pieces_left, attention_left = entry[2] / most_pieces, entry[3] / most_attention
            if dot:
                value = -(
                    w_tokens * length * left / tokens**2
                    + w_pieces * pieces_left / most_pieces
                    + w_attention * cost / most_attention * attention_left
                )
            else:
                value = (
                    w_tokens * rest * rest
                    + w_pieces * (pieces_left - 1 / most_pieces) ** 2
                    + w_attention * (attention_left - cost / most_attention) ** 2
                )
            if best is None or value < best[0]:
                if best:
                    heapq.heappush(classes[best[1]], best[2])
                best = (value, left, entry)
            else:
                heapq.heappush(classes[left], entry)
        if best:
            _, left, (_, chosen, pieces_left, attention_left) = best
            if not classes[left]:
                del open_left[bisect.bisect_left(open_left, left)]
        else:
            left, chosen, pieces_left, attention_left = tokens, n, most_pieces, most_attention
            n += 1
        sequence[i], offset[i] = chosen, tokens - left
        left, pieces_left, attention_left = left - length, pieces_left - 1, attention_left - cost
        if left and pieces_left:
            norm = w_pieces * (pieces_left / most_pieces) ** 2 + w_attention * (attention_left / most_attention) ** 2
            if not classes[left]:
                bisect.insort(open_left, left)
            heapq.heappush(classes[left], (-norm if dot else norm, chosen, pieces_left, attention_left))
    return sequence, offset, n


def pack(
    df: DataFrame,
    path: str,
    pattern: str,
    limits: Limits = Limits(),
    end: int = 2,
    pieces_per_block: int = PIECES_PER_BLOCK,
    key: str = "doc_id",
    text: str = "text",
    added: Mapping[str, int] = {},
) -> DataFrame:
    """Cuts documents into pieces and puts those into sequences.

    Returns, per piece, key, ``piece`` (from 0), ``start`` (the document's ids before it), ``length``,
    ``ids_crc32`` (of the ids as little-endian 32-bit numbers), ``sequence_id`` and ``offset`` (place in
    the sequence, without gaps from 0). Only documents of more than ``limits.tokens`` ids are cut; then
    all pieces but the first have that length. A null text is an empty one. Repeated rows and rows with
    null keys are packed like any other. ``added`` are tokens that texts may hold literally, with their ids
    (see ``added_tokens``). An empty table gives no rows; other columns are not looked at.

    Texts are encoded where they are read. The pieces without their texts are written once, dealt out
    evenly into blocks of about ``pieces_per_block``, and each block is packed in a task of its own.
    Numbers of sequences are unique over the table; they have gaps between blocks.
    """
    made = written(pieces(df, path, pattern, end, limits.tokens, key, text, added), "pieces")

    def fill(block_key, block):
        block = block.take(pa.array(np.lexsort((block["piece"].to_numpy(), block["_row"].to_numpy()))))
        sequence, offset, _ = best_fit(block["length"].to_numpy(), limits)
        numbers = (int(block_key[0].as_py()) << 32) + sequence
        kept = {n: block[n] for n in ("_id", "piece", "start", "length", "ids_crc32")}
        return pa.table(kept | {"sequence_id": pa.array(numbers, pa.int64()), "offset": pa.array(offset, pa.int64())})

    blocks = max(1, round(made.count() / pieces_per_block))
    dealt = made.withColumn("_block", F.pmod(F.xxhash64("_row", "piece"), F.lit(blocks)))
    return dealt.groupBy("_block").applyInArrow(fill, PACKED).withColumnRenamed("_id", key)
