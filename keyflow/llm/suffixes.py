"""Repeated byte strings across documents, found by refining buckets of sampled suffixes.

Suffixes start in buckets of equal q-grams. A bucket is refined by the identifiers of the buckets that
its suffixes' later offsets are in: identifiers of depth d at a place and at later ones give those of
greater depth, and each step uses what the one before has made. Here identifiers are 64-bit hashes, so
that the whole corpus needs no common sort: depth 13 gives 26, and 26 gives 38, 50 and 74.

Only some suffixes take part, chosen by content so that equal strings choose alike: in each string of 50
bytes, the place whose 26-gram has the smallest identifier (an anchor). What is refined shrinks:

1. anchors stay if their 26-gram occurs elsewhere;
2. of those that also share 24 bytes to the left and right, only the ones in the smallest document go on:
   every string of 50 bytes around the others occurs there too. And of what goes on, only the side whose
   12 more bytes also occur in other surroundings: where they do not, nothing is left to compare;
3. the strings of 50 bytes around what is left are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.blocks import Blocks, blocks, in_order
from keyflow.llm.shingles import mix

LENGTH, DEPTH = 50, 26
SPAN = LENGTH - DEPTH  # from the first to the last place of a 26-gram in a string of 50 bytes
HALF = SPAN // 2
PAD = LENGTH + SPAN  # bytes of no document between documents
CHUNK_BYTES = 1 << 18  # worked on at once, small enough for a processor's cache
BLOCK_BYTES = 2 << 20  # a task holds some thirty bytes for each byte of a block
PART_HASHES = 2 << 20
LAST = np.iinfo(np.int64).max  # stands for a null id: after all others

# An identifier for each byte, and one for the padding.
IDS = mix(np.arange(1, 258, dtype=np.uint64))
# A factor for each refinement; any odd numbers without a pattern.
FACTORS = mix(np.arange(1001, 1033, dtype=np.uint64)) | np.uint64(3)

# The steps in which blocks ask, by number: whether an identifier stands elsewhere, or in a smaller document (in those with
# ids), or (of sides) in other surroundings.
GRAMS, AROUND, SIDES, STRINGS = 1, 2, 3, 4
WITH_IDS = (AROUND, STRINGS)

CELL = "part int, block long, step int, hashes binary, ids binary"
ANSWER = "block long, part int, step int, answer binary"
RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def refined(first: np.ndarray, later: np.ndarray, k: int) -> np.ndarray:
    """Identifiers of buckets refined by those of a later offset, in the ``k``-th way."""
    with np.errstate(over="ignore"):
        return first * FACTORS[k] + later


def _sliding(h: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each run of ``width`` values; shorter by ``width - 1``."""
    have = 1
    while 2 * have <= width:
        h = pick(h[:-have], h[have:])
        have *= 2
    return pick(h[: len(h) - (width - have)], h[width - have :]) if have < width else h


@dataclass
class Chunk:
    """Some documents of a block: their bytes, 26-gram identifiers and anchors."""

    raw: list[bytes]
    ids: np.ndarray
    starts: np.ndarray  # of each document in the padded buffer
    grams: np.ndarray  # identifiers of depth 26 at every place of the padded buffer
    rank: np.ndarray  # their upper halves plus 1, by which anchors are chosen
    least: np.ndarray  # the smallest rank in each string of 50 bytes; 0 where there is no such string
    anchors: np.ndarray  # places
    owner: np.ndarray  # document of each anchor

    @classmethod
    def of(cls, raw: list[bytes], ids: np.ndarray) -> Chunk:
        sizes = np.array([len(r) for r in raw], np.int64)
        starts = PAD + np.concatenate([[0], np.cumsum(sizes + PAD)[:-1]])
        codes = np.full(int((sizes + PAD).sum()) + PAD + DEPTH, 256, np.uint16)
        whole = np.zeros(len(codes), bool)
        for start, body in zip(starts, raw):
            codes[start : start + len(body)] = np.frombuffer(body, np.uint8)
            whole[start : max(start, start + len(body) - LENGTH + 1)] = True
        one = IDS[codes]
        two = refined(one[:-1], one[1:], 0)
        four = refined(two[:-2], two[2:], 1)
        eight = refined(four[:-4], four[4:], 2)
        twelve = refined(eight[:-4], four[8:], 3)
        thirteen = refined(twelve[:-1], one[12:], 4)
        grams = mix(refined(thirteen[:-13], thirteen[13:], 5))
        rank = np.maximum((grams >> np.uint64(32)).astype(np.uint32), np.uint32(1))
        low = _sliding(rank, SPAN + 1, np.minimum)
        least = np.zeros(len(rank), np.uint32)
        np.multiply(low, whole[: len(low)], out=least[: len(low)])
        high = _sliding(np.concatenate([np.zeros(SPAN, np.uint32), least]), SPAN + 1, np.maximum)
        anchors = np.flatnonzero(high == rank)
        return cls(raw, ids, starts, grams, rank, least, anchors, np.searchsorted(starts, anchors, side="right") - 1)

    def strings(self, at: np.ndarray) -> np.ndarray:
        """Identifiers of depth 50."""
        return mix(refined(self.grams[at], self.grams[at + SPAN], 6))

    def surroundings(self, at: np.ndarray) -> np.ndarray:
        """Identifiers of depth 74, of what all strings of 50 bytes around an anchor are made of."""
        return mix(refined(refined(self.grams[at - SPAN], self.grams[at], 7), self.grams[at + SPAN], 8))

    def sides(self, at: np.ndarray) -> np.ndarray:
        """Identifiers of depth 38: of the 12 bytes before an anchor and its 26-gram, then of that and the 12 bytes after it."""
        before = refined(self.grams[at - HALF], self.grams[at], 9)
        return mix(np.concatenate([before, refined(self.grams[at], self.grams[at + HALF], 10)]))

    def around(self, at: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None):
        """Places of the strings of 50 bytes that have one of these anchors as their smallest 26-gram, and which anchor.

        With ``before`` and ``after`` given, only those that reach 12 bytes or more to a side for which they hold.
        """
        back = np.arange(SPAN + 1)
        places = at[:, None] - back[None, :]
        wanted = self.least[places] == self.rank[at][:, None]
        if before is not None:
            wanted &= (before[:, None] & (back >= HALF)[None, :]) | (after[:, None] & (back <= HALF)[None, :])
        anchor, k = np.nonzero(wanted)
        return places[anchor, k], anchor


def chunks(group: pa.Table) -> Iterator[Chunk]:
    group = in_order(group)
    ids = np.array([LAST if i is None else i for i in group["id"].to_pylist()], np.int64)
    raw, size, first = [], 0, 0
    for k, text in enumerate(group["text"].cast(pa.binary())):
        raw.append(text.as_py() or b"")
        size += len(raw[-1]) + PAD
        if size >= CHUNK_BYTES:
            yield Chunk.of(raw, ids[first : k + 1])
            raw, size, first = [], 0, k + 1
    if raw:
        yield Chunk.of(raw, ids[first:])


class Bucket:
    """The distinct identifiers of a block, in order, with the smallest document of each; they are what it asks about."""

    def __init__(self, hashes: list[np.ndarray], ids: list[np.ndarray] | None = None):
        every = np.concatenate([np.zeros(0, np.uint64), *hashes])
        if ids is None:
            every, owners = np.sort(every), None
        else:
            order = np.argsort(every)
            every, owners = every[order], np.concatenate([np.zeros(0, np.int64), *ids])[order]
        first = np.ones(len(every), bool)
        first[1:] = every[1:] != every[:-1]
        first = np.flatnonzero(first)
        self.hashes = every[first]
        self.ids = None if owners is None else np.minimum.reduceat(owners, first) if len(first) else owners
        self.repeated = np.diff(np.append(first, len(every))) > 1

    @classmethod
    def of_sides(cls, sides: list[np.ndarray], surroundings: list[np.ndarray]) -> Bucket:
        """Distinct sides, each with the lower half of its surroundings, and whether it has several."""
        every, around = np.concatenate([np.zeros(0, np.uint64), *sides]), np.concatenate([np.zeros(0, np.uint64), *surroundings])
        order = np.lexsort((around, every))
        made = cls([every])
        first = np.searchsorted(every[order], made.hashes)
        last = np.append(first[1:], len(every)) - 1
        low, high = around[order][first], around[order][last] if len(first) else around
        made.repeated, made.surroundings = low != high, low.astype("<u4")
        return made

    def cells(self, block: int, step: int, parts: int) -> list[tuple]:
        # Parts are ranges of identifiers, so that the order of all is that of each part.
        part = (((self.hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        names, starts = np.unique(part, return_index=True)
        out = []
        for name, s, e in zip(names, starts, [*starts[1:], len(part)]):
            ids = b""
            if self.ids is not None:
                base = self.ids[s:e].min()
                far = self.ids[s:e].astype(np.uint64) - np.uint64(base.astype(np.uint64))
                ids = base.tobytes() + far.astype("<u4" if far.max() < 1 << 32 else "<u8").tobytes()
            elif step == SIDES:
                ids = np.packbits(self.repeated[s:e]).tobytes() + self.surroundings[s:e].tobytes()
            elif self.repeated[s:e].any():
                ids = np.packbits(self.repeated[s:e]).tobytes()
            hashes = self.hashes[s:e].astype("<u4" if self.ids is None else "<u8").tobytes()
            out.append((int(name), block, step, hashes, ids))
        return out

    def index(self, hashes: np.ndarray) -> np.ndarray:
        """Where each of these identifiers, which are all there, is."""
        return np.searchsorted(self.hashes, hashes)


def _table(cells: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    columns = [pa.array([c[i] for c in cells], kind) for i, kind in enumerate(kinds)]
    return pa.table(columns, ["part", "block", "step", "hashes", "ids"])


def _answers(step: int, answers: pa.Table, asked: Bucket) -> np.ndarray:
    """For each identifier that a block has asked about in a step, whether the answer is yes."""
    rows = sorted((r for r in answers.to_pylist() if r["step"] == step), key=lambda r: r["part"])
    said = np.frombuffer(b"".join(r["answer"] for r in rows), np.uint8)
    if len(said) != len(asked.hashes):
        raise ValueError(f"a block that asked about {len(asked.hashes)} identifiers got {len(said)} answers")
    return said > 0


class Search:
    """What a block knows by the answers it has got so far; the rest it works out again from its texts."""

    def __init__(self, group: pa.Table, answers: pa.Table | None = None):
        self.block, self.answers = list(chunks(group)), answers
        self.grams = Bucket([c.grams[c.anchors] for c in self.block])

    def second(self) -> tuple[Bucket, Bucket]:
        """Of anchors whose 26-gram occurs elsewhere, the surroundings and the sides."""
        yes = _answers(GRAMS, self.answers, self.grams)
        around, ids, sides = [], [], []
        for c in self.block:
            keep = yes[self.grams.index(c.grams[c.anchors])]
            c.anchors, c.owner = c.anchors[keep], c.owner[keep]
            around.append(c.surroundings(c.anchors))
            ids.append(c.ids[c.owner])
            sides.append(c.sides(c.anchors))
        self.around, self.sides = Bucket(around, ids), Bucket.of_sides(sides, [np.tile(a, 2) for a in around])
        return self.around, self.sides

    def third(self) -> Bucket:
        """The strings around anchors that no smaller document has in the same surroundings."""
        self.second()
        smaller, shared = _answers(AROUND, self.answers, self.around), _answers(SIDES, self.answers, self.sides)
        hashes, ids = [], []
        self.settled, self.open = [], []
        for c in self.block:
            k = self.around.index(c.surroundings(c.anchors))
            done = smaller[k] | (c.ids[c.owner] > self.around.ids[k])
            at, owner = c.anchors[~done], c.owner[~done]
            before, after = np.split(shared[self.sides.index(c.sides(at))], 2)
            places, anchor = c.around(at, before, after)
            self.settled.append(c.anchors[done])
            self.open.append((places, c.strings(places), c.ids[owner[anchor]]))
            hashes.append(self.open[-1][1])
            ids.append(self.open[-1][2])
        self.strings = Bucket(hashes, ids)
        return self.strings

    def last(self) -> list[tuple]:
        self.third()
        earlier = _answers(STRINGS, self.answers, self.strings)
        out = []
        for c, settled, (places, hashes, ids) in zip(self.block, self.settled, self.open):
            k = self.strings.index(hashes)
            marked = np.zeros(len(c.grams) + LENGTH, np.int32)
            marked[c.around(settled)[0]] = 1
            marked[places[earlier[k] | (ids > self.strings.ids[k])]] = 1
            sums = np.cumsum(marked)
            covered = sums > 0
            covered[LENGTH:] = sums[LENGTH:] > sums[:-LENGTH]
            for start, body, doc in zip(c.starts, c.raw, c.ids):
                gone = covered[start : start + len(body)]
                n = int(np.count_nonzero(gone))
                kept = np.frombuffer(body, np.uint8)[~gone].tobytes() if n else body
                runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0]) if n else 0
                out.append((None if doc == LAST else int(doc), len(body), n, runs, hashlib.sha256(kept).hexdigest()))
        return out


def _said(step: int, asked: list[dict]) -> Iterator[tuple]:
    """The answers to the cells of one step in one part."""
    lists = [np.frombuffer(r["hashes"], "<u8" if step in WITH_IDS else "<u4") for r in asked]
    sizes = [len(x) for x in lists]
    every = np.concatenate(lists)
    order = np.argsort(every)
    ranked = every[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(ranked)))
    said = np.zeros(len(every), np.uint8)
    if step in WITH_IDS:
        ids = np.concatenate([_ids(r["ids"], n) for r, n in zip(asked, sizes)])
        smallest = np.minimum.reduceat(ids[order], first)
        said[order] = np.repeat(smallest, many) < ids[order]
    elif step == SIDES:
        several = np.concatenate([np.unpackbits(np.frombuffer(r["ids"], np.uint8), count=n) for r, n in zip(asked, sizes)])
        around = np.concatenate([np.frombuffer(r["ids"][-4 * n :], "<u4") for r, n in zip(asked, sizes)])[order]
        differ = np.minimum.reduceat(around, first) != np.maximum.reduceat(around, first)
        differ |= np.maximum.reduceat(several[order], first) > 0
        said[order] = np.repeat(differ, many)
    else:
        said[order] = np.repeat(many > 1, many)
        for r, n, end in zip(asked, sizes, np.cumsum(sizes)):
            if r["ids"]:
                said[end - n : end] |= np.unpackbits(np.frombuffer(r["ids"], np.uint8), count=n)
    for r, n, end in zip(asked, sizes, np.cumsum(sizes)):
        yield r["block"], r["part"], step, said[end - n : end].tobytes()


def _ids(packed: bytes, n: int) -> np.ndarray:
    base = np.frombuffer(packed[:8], np.int64)[0]
    far = np.frombuffer(packed[8:], "<u4" if len(packed) == 8 + 4 * n else "<u8")
    return (far.astype(np.uint64) + base.astype(np.uint64)).astype(np.int64)


def _count(key, group):
    """Answers a part's cells; answers of earlier steps, which stand under -1 - part, are passed on."""
    rows = group.to_pylist()
    out = [(r["block"], -1 - r["part"], r["step"], r["hashes"]) for r in rows if r["part"] < 0]
    for step in sorted({r["step"] for r in rows if r["part"] >= 0}):
        out.extend(_said(step, [r for r in rows if r["part"] >= 0 and r["step"] == step]))
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["block", "part", "step", "answer"])


def _searched(rows: Blocks) -> DataFrame:
    parts = rows.parts(12, PART_HASHES)  # about one anchor for every twelve bytes
    by_block = rows.rows.groupBy("block")

    def answered(cells: DataFrame):
        dealt = cells.withColumn("_to", F.when(F.col("part") < 0, -1 - F.col("part")).otherwise(F.col("part")))
        return dealt.groupBy("_to").applyInArrow(_count, ANSWER)

    def ask_first(key, group):
        return _table(Search(group).grams.cells(key[0].as_py(), GRAMS, parts))

    def carried(answers):
        return [(-1 - r["part"], r["block"], r["step"], r["answer"], b"") for r in answers.to_pylist()]

    def ask_second(key, group, answers):
        block = key[0].as_py()
        around, sides = Search(group, answers).second()
        return _table(around.cells(block, AROUND, parts) + sides.cells(block, SIDES, parts) + carried(answers))

    def ask_third(key, group, answers):
        return _table(Search(group, answers).third().cells(key[0].as_py(), STRINGS, parts) + carried(answers))

    def finish(key, group, answers):
        out = Search(group, answers).last()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = [part.split()[0] for part in RESULT.split(", ")]
        return pa.table([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    found = answered(by_block.applyInArrow(ask_first, CELL))
    for ask in (ask_second, ask_third):
        found = answered(by_block.cogroup(found.groupBy("block")).applyInArrow(ask, CELL))
    return by_block.cogroup(found.groupBy("block")).applyInArrow(finish, RESULT)


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` (of what stays).

    A byte goes if a string of 50 bytes that covers it also starts in a row with a smaller key. Strings
    are those of the input; they do not cross documents, and those repeated only in rows with the same
    key stay. A null text is an empty one, and one of fewer than 50 bytes loses nothing. Null keys count
    as larger than all others and as equal to each other. An empty table gives no rows; other columns
    are not looked at.

    Strings are compared by 64-bit identifiers. A block's distinct identifiers leave it once, whatever
    number of its documents have them.
    """
    return _searched(blocks(df, F.col(key), F.col(text), BLOCK_BYTES)).withColumnRenamed("id", key)
