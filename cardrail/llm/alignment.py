"""Alignment of two tokenizations of the same bytes, and how often token ids of both end together.

Tokens of both tokenizers are taken by the bytes that they cover. Where a token of each ends at the same byte, a group
ends. Most groups are one token against one, so the arrays of token ends agree along a diagonal: at a shift of the second
index against the first. ``diagonal_runs`` compares slices of both arrays at the present shift, twice as long each time,
halves its steps at the first difference, and so jumps a whole stretch at once; the irregular group behind it is resolved
by walking to the next common end, which gives the new shift.

1. One narrow pass encodes, aligns and digests the texts. Some hundred thousand links at a time are a block, stored as one
   row: the different pairs of ids in it, how often each, and for each document which of them it holds.
2. Pairs are counted over the blocks, and of each second id the highest count is found. Blocks have added up
   their pairs before, so that a pair that is everywhere is one row for each block.
3. The counts go back to the blocks, whose documents are summed up.

Space + text is encoded by a byte-level BPE file of the tokenizers library (A), and the text by a sentencepiece BPE model
that adds the space itself (B). Added tokens in a text are plain text.

Defined results: a null or empty text, and one whose tokens of A or of B don't spell space + text, have no tokens and no
digest; rows come out as often as they come in, also with a null or repeated ``doc_id``; an empty table gives an empty
result; other columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from cardrail.llm.byte_bpe import MARK, model_bytes
from cardrail.llm.common import held_in_worker, slices, small, written
from cardrail.llm.lexicon import Vocabulary
from cardrail.llm.segments import Rows, cut, numbered

#: Characters that make a block, and chunks that a worker remembers.
BLOCK_CHARS, REMEMBERED = 2_000_000, 500_000

#: Chunks encoded in one call.
TOGETHER = 1_000

#: The characters with the Unicode property White_Space.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
BLOCK_SCHEMA = (
    "block long, doc_id array<long>, n_a array<int>, n_b array<int>, n_groups array<int>, sha array<string>, "
    "held array<binary>, pairs array<long>, times array<long>"
)

#: In front of a word, and instead of a byte that no piece holds.
SPACE, BYTE = "▁", re.compile(r"<0x([0-9A-F]{2})>\Z")

#: Stands between words that are mapped together: no text holds a lone surrogate.
APART = "\ud800"

#: A chunk of one space and a word.
PLAIN = re.compile(f" [^{BLANK}]+").fullmatch


def diagonal_runs(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Runs (i, j, n): groups end with tokens i and j, i + 1 and j + 1, ..., n of them.

    ``a`` and ``b`` hold where tokens end, ascending, with the same last end. The first group of a run is any, all others
    are one token against one.
    """
    out, i, j, size_a, size_b = [], 0, 0, len(a), len(b)
    while i < size_a:
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        p, q, step = i + 1, j + 1, 1
        most = min(size_a - p, size_b - q)
        while step <= most and a[p : p + step] == b[q : q + step]:
            p, q, most, step = p + step, q + step, most - step, 2 * step
        while step > 1:
            step //= 2
            if step <= most and a[p : p + step] == b[q : q + step]:
                p, q, most = p + step, q + step, most - step
        out.append((i, j, p - i))
        i, j = p, q
    return out


class Digits:
    """Decimal names of ids, written side by side without a loop over tokens."""

    #: Tokens written together.
    PART = 1 << 15

    def __init__(self, n: int):
        self.size = np.array([len(str(i)) for i in range(n)], "i8")
        width = int(self.size.max())
        # zeros in front, which are left out, and room for a character behind
        self.padded = np.frombuffer(b"".join(str(i).encode().rjust(width, b"\0") + b"\0" for i in range(n)), "u1").reshape(n, -1)

    def write(self, ids: np.ndarray, behind: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Each id's digits and one character behind it, in one row; and where each ends."""
        parts = []
        for a in range(0, len(ids), self.PART):
            rows = self.padded[ids[a : a + self.PART]]
            rows[:, -1] = behind[a : a + self.PART]
            parts.append(rows[rows != 0].tobytes())
        return b"".join(parts), np.cumsum(self.size[ids] + 1)


def groups_text(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, digits: Digits) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2;`` as bytes: the tokens of groups that end with A's tokens ``i`` and B's tokens ``j``; and where
    each group ends."""
    size_a, size_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
    before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    place_a = np.arange(len(a)) + np.repeat(before_b, size_a)
    place_b = np.arange(len(b)) + np.repeat(before_a + size_a, size_b)
    ids, behind = np.empty(len(a) + len(b), "i8"), np.full(len(a) + len(b), ord(","), "u1")
    ids[place_a], ids[place_b] = a, b
    behind[place_a[i]], behind[place_b[j]] = ord("|"), ord(";")
    text, ends = digits.write(ids, behind)
    return text, ends[place_b[j]]


def between(ids: list[int], mark: int) -> Rows:
    """Rows of the ids before each mark, from the mark before it on."""
    flat = np.array(ids, "i8")
    marks = np.flatnonzero(flat == mark)
    return Rows(flat[flat != mark], np.diff(marks, prepend=-1) - 1)


class ByteLevel:
    """A byte-level BPE file, run by a sentencepiece model of the same pieces and order: many words in one call."""

    def __init__(self, path: str):
        import sentencepiece

        self.coder = Vocabulary(path)
        with open(path, "rb") as file:
            model = json.load(file)["model"]
        order = [a + b for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        if [model["vocab"][m] for m in order] != list(range(256, 256 + len(order))):
            raise ValueError(f"{path}: ids are not in the order of the merges")
        self.bytes_of = self.coder.bytes_of[: 256 + len(order)]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.bytes_of))
        self.mapped = Mapped(self.coder.to_characters)

    def encode(self, chunks: list[str]) -> Rows:
        # words with one space before them are split in one go: no pre-token goes over the end of such a chunk
        plain = [bool(PLAIN(c)) for c in chunks]
        words = self.coder.words("".join([c for c, yes in zip(chunks, plain, strict=True) if yes]), added=False)
        ends = np.cumsum([len(c) for c, yes in zip(chunks, plain, strict=True) if yes])
        count = np.zeros(len(chunks), "i8")
        count[plain] = np.diff(np.searchsorted(np.cumsum(list(map(len, words))), ends, "right"), prepend=0)
        others = [self.coder.words(c, added=False) for c, yes in zip(chunks, plain, strict=True) if not yes]
        count[~np.array(plain, bool)] = list(map(len, others))
        row = np.argsort(np.argsort(~np.array(plain, bool), kind="stable"), kind="stable")  # plain ones come first
        for more in others:
            words += more
        found = between(self.model.encode(APART.join([*words, ""]).translate(self.mapped)), len(self.bytes_of))
        size = np.empty(len(chunks), "i8")
        size[row] = count
        ids = np.diff(np.r_[0, np.cumsum(found.lengths)][np.cumsum(size)], prepend=0)
        return Rows(found.values, ids).take(row)


class Mapped(dict):
    """For ``str.translate``: a character's bytes as the characters that stand for them."""

    def __init__(self, of_byte: dict[int, str]):
        super().__init__({ord(APART): MARK})
        self.of_byte = of_byte

    def __missing__(self, code: int) -> str:
        self[code] = "".join(self.of_byte[b] for b in chr(code).encode())
        return self[code]


class PieceLevel:
    """A sentencepiece model that puts a space in front of a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of, inside = [], re.compile(f"[^{BLANK}] |\n")
        for i, piece in enumerate(map(self.model.id_to_piece, range(len(self.model)))):
            of_byte = BYTE.match(piece) if self.model.is_byte(i) else None
            if self.model.is_control(i) or self.model.is_unknown(i):
                self.bytes_of.append(None)
            elif of_byte:
                self.bytes_of.append(bytes([int(of_byte[1], 16)]))
            else:
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
                if inside.search(piece.replace(SPACE, " ")):
                    raise ValueError(f"{path}: the piece {piece!r} crosses words or lines")
        self.line = self.model.piece_to_id("<0x0A>")

    def encode(self, chunks: list[str]) -> Rows:
        # nothing merges with a line break: it keeps chunks apart, and off the space that the model puts in front
        broken = np.array(["\n" in c for c in chunks], bool)
        whole = between(self.model.encode("\n".join(["", *(c for c in chunks if "\n" not in c), ""])), self.line)
        lines = Rows.of([x[2:] for x in self.model.encode([f"\n{c}" for c in chunks if "\n" in c], num_threads=1)])
        both = Rows(np.concatenate([whole.values, lines.values]), np.concatenate([whole.lengths, lines.lengths]))
        row = np.where(broken, len(whole.lengths) + np.cumsum(broken) - 1, np.cumsum(~broken))  # the first is that space
        return both.take(row)


class Encoder:
    """Both tokenizations of texts by chunks: white space and the word behind it. No token of either goes from a word
    into a space or line break behind it (into other white space it may), so a chunk is encoded once, and remembered."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), PieceLevel(path_b)
        if any(b"" in x.bytes_of for x in (self.a, self.b)):
            raise ValueError("a token without bytes")
        self.sizes = [np.array([len(x or b"") for x in t.bytes_of], "i8") for t in (self.a, self.b)]
        other = BLANK.replace("\t-\r ", "\t\x0b-\r")
        self.split = re.compile(f"[{BLANK}]*[^{BLANK}]+(?:[{other}][{BLANK}]*[^{BLANK}]*)*|[{BLANK}]+").findall
        self._forget()

    def _forget(self) -> None:
        # a chunk's number, the rows of A's and B's ids by that number, and the numbers of chunks that are not spelled
        self.known: dict[str, int] = {}
        self.rows = [Rows(np.zeros(0, "i8"), np.zeros(0, "i8")) for _ in "ab"]
        self.wrong: set[int] = set()

    def _learn(self, chunks: list[str]) -> None:
        if len(self.known) > REMEMBERED:
            self._forget()
        new, added = [c for c in chunks if c not in self.known], ([], [])
        for k in range(0, len(new), TOGETHER):
            part = new[k : k + TOGETHER]
            size = np.array([len(c.encode()) for c in part])
            for i, coder in enumerate((self.a, self.b)):
                rows = coder.encode(part)
                spelled = b"".join(map(coder.bytes_of.__getitem__, rows.values.tolist()))
                sizes = np.diff(np.r_[0, np.cumsum(self.sizes[i][rows.values])][np.cumsum(rows.lengths)], prepend=0)
                if (sizes != size).any() or spelled != "".join(part).encode():
                    ends = np.cumsum(sizes).tolist()
                    for n, (c, x, y) in enumerate(zip(part, [0, *ends], ends)):
                        if spelled[x:y] != c.encode():
                            self.wrong.add(len(self.known) + n)
                added[i].append(rows)
            self.known.update(zip(part, range(len(self.known), len(self.known) + len(part)), strict=True))
        for i in (0, 1):
            parts = [self.rows[i], *added[i]]
            self.rows[i] = Rows(np.concatenate([x.values for x in parts]), np.concatenate([x.lengths for x in parts]))

    def encode(self, texts: list[str]) -> list[Rows]:
        """The ids of A and of B of each text; none of either where one doesn't spell it."""
        chunks, codes, ends = numbered([self.split(t) for t in texts])
        self._learn(chunks)
        codes = np.fromiter(map(self.known.__getitem__, chunks), "i8", len(chunks))[codes]
        if self.wrong:
            sizes, wrong = np.diff(ends, prepend=0), np.isin(codes, list(self.wrong))
            bad = np.diff(np.r_[0, np.cumsum(wrong)][ends], prepend=0) > 0
            codes, ends = codes[~np.repeat(bad, sizes)], np.cumsum(np.where(bad, 0, sizes))
        out = []
        for held in self.rows:
            rows = held.take(codes)
            until = np.r_[0, np.cumsum(rows.lengths)][ends]
            out.append(Rows(rows.values, np.diff(until, prepend=0)))
        return out


@dataclass
class Aligned:
    """Some texts: their numbers of tokens and of groups, the pair of ids (A's in the upper half) that ends each group of
    all of them in a row, and their digests."""

    n_a: np.ndarray
    n_b: np.ndarray
    groups: np.ndarray
    pairs: np.ndarray
    sha: list[str]


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.encoder = Encoder(path_a, path_b)
        self.digits = Digits(max(map(len, self.encoder.sizes)))

    def align(self, texts: list[str | None]) -> Aligned:
        a, b = self.encoder.encode([f" {t}" if t else "" for t in texts])
        # all texts in a row: each ends with a common end of both
        ends = [np.cumsum(sizes[x.values]) for sizes, x in zip(self.encoder.sizes, (a, b), strict=True)]
        i, j, n = np.array(diagonal_runs(*(x.tolist() for x in ends)), "i8").reshape(-1, 3).T
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i, j = np.repeat(i, n) + step, np.repeat(j, n) + step
        until = np.searchsorted(i, np.cumsum(a.lengths), "left")  # groups up to each text's end
        text, edges = groups_text(a.values, b.values, i, j, self.digits)
        cuts = np.r_[0, edges][np.r_[0, until]].tolist()
        raw = memoryview(text)
        sha = [hashlib.sha256(raw[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(cuts, cuts[1:])]
        pairs = a.values[i] << 32 | b.values[j]
        return Aligned(a.lengths, b.lengths, np.diff(until, prepend=0), pairs, sha)


def _held(numbers: np.ndarray) -> bytes:
    """Which pairs of the block a document holds, and how often: the width of a number, then both in a row."""
    place, times = np.unique(numbers, return_counts=True)
    kind = "<u2" if not len(numbers) or max(place[-1], times.max()) < 1 << 16 else "<u4"
    return kind[-1].encode() + np.r_[place, times].astype(kind).tobytes()


def _places(held: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(held, f"<u{held[:1].decode()}", offset=1).astype("i8")
    return both[: len(both) // 2], both[len(both) // 2 :]


def blocks(docs: DataFrame, path_a: str, path_b: str, chars: int) -> DataFrame:
    """The aligned documents, a block a row, stored. A narrow pass."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        aligner = held_in_worker(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        block = TaskContext.get().partitionId() << 32
        for batch in small(batches, 10_000):
            a, doc_ids = 0, batch.column("doc_id")
            for texts in slices([t or "" for t in batch.column("text").to_pylist()], chars):
                found = aligner.align(texts)
                pairs, number, times = np.unique(found.pairs, return_inverse=True, return_counts=True)
                row = {
                    "block": block,
                    "doc_id": doc_ids.slice(a, len(texts)).to_pylist(),
                    "n_a": found.n_a,
                    "n_b": found.n_b,
                    "n_groups": found.groups,
                    "sha": found.sha,
                    "held": [_held(x) for x in cut(number, np.cumsum(found.groups))],
                    "pairs": pairs,
                    "times": times,
                }
                texts_, longs, ints = pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32())
                kinds = [pa.int64(), longs, ints, ints, ints, texts_, pa.list_(pa.binary()), longs, longs]
                arrays = [pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, list(row))
                block, a = block + 1, a + len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(rows.mapInArrow(run, BLOCK_SCHEMA), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, in how many links it is, and whether no pair of the same second id is in more."""
    both = F.explode(F.arrays_zip("pairs", "times")).alias("x")
    counts = aligned.select(both).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n"))
    same = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(same)).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document its tokens, groups and links, how many links are the best for their second id, the sum of the
    links' counts, and the digest of the groups."""
    aligned = blocks(docs, path_a, path_b, block_chars)
    counts = written(pair_counts(aligned), "pair-counts")
    places = aligned.select("block", F.posexplode("pairs").alias("place", "pair"))
    back = places.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("place", "n", "best")).alias("counts"))
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def sums(batches):
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                counts = row.column("counts").flatten()
                n, best = np.zeros(len(counts), "i8"), np.zeros(len(counts), "i8")
                if len(counts):
                    place = counts.field("place").to_numpy(zero_copy_only=False)
                    n[place] = counts.field("n").to_numpy(zero_copy_only=False)
                    best[place] = counts.field("best").to_numpy(zero_copy_only=False)
                held = [_places(x) for x in row.column("held").flatten().to_pylist()]
                flat = [row.column(c).flatten() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_groups")]
                flat = [x.cast(pa.int64()) for x in flat]  # a group's last tokens are its one link
                flat += [pa.array([int(v[p] @ t) for p, t in held], pa.int64()) for v in (best, n)]
                yield pa.RecordBatch.from_arrays([*flat, row.column("sha").flatten()], names)

    kept = aligned.select("block", "doc_id", "n_a", "n_b", "n_groups", "sha", "held")
    return kept.join(back, "block", "left").drop("block").mapInArrow(sums, SCHEMA)
