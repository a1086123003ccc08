"""Best-fit packing of token sequences under several capacities.

Documents are cut into pieces of at most ``capacity`` tokens. A bin has three capacities: tokens, pieces, and attention
cost (the sum of the squared lengths of its pieces). Pieces come in order of falling length; each goes to the open bin
that fits it under every capacity and leaves the smallest weighted norm of what remains (``fit="norm"``), or that has
the largest weighted dot product of what it has left and what the piece takes (``fit="dot"``); if none fits, it opens a
bin. All capacities count as shares of their whole.

Pieces are dealt out evenly to groups of at most ``group_pieces``, and a task packs each group: its memory is bounded,
no key decides where a piece goes, and a group leaves one bin partly filled on average.

Defined results: a null text counts as empty and is packed as its end id; rows with a null or repeated ``doc_id`` are
packed one by one; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cardrail.llm.common import small, written
from cardrail.llm.word_ids import word_ids

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds at most. ``attention`` is in squared tokens; one full piece takes ``tokens`` squared."""

    tokens: int = 2048
    pieces: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    fit: str = "norm"


def pack(lengths: Sequence[int], limits: Capacities) -> tuple[list[int], list[int]]:
    """The bin of each piece, and its offset there.

    Open bins stand by the tokens they have left. Bins with the same rest are the same to a piece, so one entry is
    tried for all of them. For the norm, bins are tried from the smallest rest of tokens on, until that rest alone is
    worse than the best norm so far; the dot product tries them all.
    """
    whole = (limits.tokens, limits.pieces, limits.attention)
    shares = [w / c**2 for w, c in zip(limits.weights, whole, strict=True)]
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    opened = 0
    rests: dict[int, dict[tuple[int, int], list[int]]] = {}  # tokens left: (pieces left, attention left): bins
    levels: list[int] = []  # the tokens left of some open bin, ascending

    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        takes = (lengths[i], 1, lengths[i] ** 2)
        if any(t > c for t, c in zip(takes, whole, strict=True)):
            raise ValueError(f"a piece of {lengths[i]} tokens fits into no sequence")
        best, found = float("inf"), None
        for tokens in levels[bisect.bisect_left(levels, takes[0]) :]:
            if limits.fit == "norm" and shares[0] * (tokens - takes[0]) ** 2 >= best:
                break
            for rest in rests[tokens]:
                if rest[0] < takes[1] or rest[1] < takes[2]:
                    continue
                left = (tokens, *rest)
                if limits.fit == "norm":
                    cost = sum(w * (r - t) ** 2 for w, r, t in zip(shares, left, takes, strict=True))
                else:
                    cost = -sum(w * r * t for w, r, t in zip(shares, left, takes, strict=True))
                if cost < best:
                    best, found = cost, left
        if found is None:
            left, number = whole, opened
            opened += 1
        else:
            left = found
            same = rests[left[0]][left[1:]]
            number = heapq.heappop(same)
            if not same:
                del rests[left[0]][left[1:]]
            if not rests[left[0]]:
                del rests[left[0]]
                del levels[bisect.bisect_left(levels, left[0])]
        bins[i], offsets[i] = number, limits.tokens - left[0]
        left = tuple(r - t for r, t in zip(left, takes, strict=True))
        if left[0] > 0 and left[1] > 0 and left[2] > 0:
            if left[0] not in rests:
                rests[left[0]] = {}
                bisect.insort(levels, left[0])
            heapq.heappush(rests[left[0]].setdefault(left[1:], []), number)
    return bins, offsets


def cut(docs: DataFrame, vocabulary: str, end_id: int, tokens: int) -> DataFrame:
    """The pieces of every document: its number, the ids before it, its length and its checksum. A narrow pass."""

    def run(batches: Iterable):
        import pyarrow as pa

        coder, end, step = word_ids(vocabulary), end_id.to_bytes(4, "little"), 4 * tokens
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in small(batches):
            rows = []
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(texts), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, PIECE_SCHEMA)


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int, limits: Capacities | None = None, group_pieces: int = 16_384
) -> DataFrame:
    """Every piece with its sequence and its offset there.

    The pieces, some 40 bytes each, are stored first: texts are encoded once, and the number of groups follows the
    number of pieces. Full pieces need no partner but take part all the same.
    """
    limits = limits or Capacities()
    pieces = written(cut(docs, vocabulary, end_id, limits.tokens), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        group = [b for b in batches if b.num_rows]
        if not group:
            return
        held = pa.Table.from_batches(group)
        bins, offsets = pack(held.column("length").to_pylist(), limits)
        first = TaskContext.get().partitionId() << 32
        held = held.append_column("sequence_id", pa.array([first + b for b in bins], pa.int64()))
        yield from held.append_column("offset", pa.array(offsets, pa.int64())).to_batches()

    return pieces.repartition(groups).mapInArrow(run, PIECE_SCHEMA + ", sequence_id long, offset long")
