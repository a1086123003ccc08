"""Phrase collocations: counts from depth-truncated suffix subtrees, built group by group of word prefixes.

Texts are cut into pieces at punctuation and line ends, and those into words. The suffix of a piece at a word is the
words from there on, at most ``Settings.longest`` of them: how often a phrase occurs is how many suffixes start with it.

1. Words are counted. The most frequent get short codes, so that a suffix is a few bytes. No phrase is more frequent than
   its words: a suffix ends before a word that is not frequent enough, as a filter of fixed size tells.
2. The suffixes are divided among groups by the prefix they start with, so that a group has about ``Settings.leaves`` of
   them at most: by their first word, where more suffixes than that start with it by their first two, and so on up to a
   word that is no more frequent than that. Only those words are listed; a hash deals the prefixes out.
3. Each group is a subtree of its own, built in memory: equal suffixes are a leaf with its total, leaves are sorted, and
   every node's count is the sum of the leaves below it, read in one pass over them. Tasks have added up equal
   suffixes of a run of texts before, and send them as one row for each group. Above the prefix a node's count is the
   sum over the groups.
4. Phrases are scored by the counts of their parts, in exact decimals.

Defined results: a null or empty text has no words; a null ``lang`` counts as ``und``; rows come out of the texts whatever
their ``doc_id``, repeated rows count as often as they are there; a language without candidates has no rows; an empty
table gives an empty result; ties in score and count go by the phrase's bytes; other columns are left out.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from cardrail.llm.common import Marked, held_in_worker, slices, small, written
from cardrail.llm.ngrams import mix
from cardrail.llm.segments import numbered

#: Where pieces end, and what separates words besides the space.
ENDS, BLANK = b".,;:!?\n\x0b\x0c\r", b"\t"
_PLAIN = bytes.maketrans(ENDS + BLANK, b"." * len(ENDS) + b" ")

#: Characters of one language whose equal suffixes a task adds up.
RUN_CHARS = 2_000_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    shortest: int = 2
    longest: int = 5
    least: int = 100
    #: A candidate goes if a longer one around it has at least this share of its count.
    share_percent: int = 100
    top: int = 2_000
    #: Suffixes in a group, on average at most half of that; more, if there were more than ``groups`` of them otherwise.
    leaves: int = 2_000_000
    groups: int = 1 << 20
    #: Words with short codes, and the most bytes of one.
    coded: int = 1 << 17
    word_bytes: int = 64


def words_of(text: str) -> list[bytes]:
    """The words of a text, with a full stop behind each piece."""
    return (text.encode().lower().translate(_PLAIN) + b".").replace(b".", b" . ").split()


def runs_of(batch) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Of some texts of a language: the different words, and the number of each in a row, from 1; 0 ends a piece."""
    by_lang = defaultdict(list)
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        by_lang[lang].append(text)
    for lang, texts in by_lang.items():
        for run in slices(texts, RUN_CHARS):
            words, codes, _ = numbered([words_of(t) for t in run])
            if b"." not in words:
                continue
            stop = words.index(b".")
            number = np.arange(len(words)) + (np.arange(len(words)) < stop)
            number[stop] = 0
            yield lang, words[:stop] + words[stop + 1 :], number[codes]


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").filter("text is not null")


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``word`` and how often it occurs. Partial counts are shuffled."""

    def run(batches):
        import pyarrow as pa

        for batch in small(batches, 2_000):
            for lang, words, row in runs_of(batch):
                n = np.bincount(row, minlength=len(words) + 1)[1:]
                columns = [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    return rows_of(docs).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Codes:
    """Bytes for words that tell by themselves where they end: three for a coded word, else a length and the word.

    A language is a word before the others. Suffixes that share words share the bytes of those, so that they are
    neighbours in the order of bytes, a shorter one first.
    """

    def __init__(self, words: list[bytes], langs: list[bytes]):
        self.words = [*words, *langs]
        self.word = {w: self._short(i) for i, w in enumerate(words)}
        self.lang = {w: self._short(len(words) + i) for i, w in enumerate(langs)}

    @staticmethod
    def _short(i: int) -> bytes:
        return (i | 1 << 23).to_bytes(3, "big")

    @staticmethod
    def _long(word: bytes) -> bytes:
        n = len(word)
        return (bytes([n]) if n < 127 else b"\x7f" + n.to_bytes(4, "big")) + word

    def of(self, words: list[bytes]) -> list[bytes]:
        return [self.word.get(w) or self._long(w) for w in words]

    def of_lang(self, lang: bytes) -> bytes:
        return self.lang.get(lang) or self._long(lang)

    def read(self, raw: bytes) -> list[bytes]:
        out, at = [], 0
        while at < len(raw):
            if raw[at] >= 128:
                out.append(self.words[int.from_bytes(raw[at : at + 3], "big") ^ 1 << 23])
                at += 3
            else:
                n, at = (raw[at], at + 1) if raw[at] < 127 else (int.from_bytes(raw[at + 1 : at + 5], "big"), at + 5)
                out.append(raw[at : at + n])
                at += n
        return out


def parts_of(raw: np.ndarray, start: np.ndarray, end: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where each part of some coded rows starts and ends, part by part; a row without it has an empty one."""
    raw = np.r_[raw, np.zeros(5, "u1")].astype("i8")
    at = start
    for _ in range(most):
        first = raw[at]
        long = (raw[at + 1] << 24) + (raw[at + 2] << 16) + (raw[at + 3] << 8) + raw[at + 4]
        size = np.where(first >= 128, 3, np.where(first < 127, first + 1, long + 5))
        until = np.where(at < end, at + size, at)
        yield at, until
        at = until


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """As Spark's ``xxhash64`` of language and word."""
    from xxhash import xxh64_intdigest

    seed = xxh64_intdigest(lang.encode(), 42)
    return np.fromiter((xxh64_intdigest(w, seed) for w in words), "u8", len(words))


def suffixes(row: np.ndarray, longest: int) -> list[np.ndarray]:
    """The columns of all suffixes of two words or more: their first word, their second and so on, 0 behind their end."""
    padded = np.r_[row, np.zeros(longest, row.dtype)]
    at = np.flatnonzero((row > 0) & (padded[1 : len(row) + 1] > 0))
    columns = [padded[at], padded[at + 1]]
    for k in range(2, longest):
        columns.append(np.where(columns[-1] > 0, padded[at + k], 0))
    return columns


def added_up(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows, in order, and how often each is there."""
    bits = max(1, int(columns[0].max(initial=0)).bit_length(), int(columns[1].max(initial=0)).bit_length())
    keys = columns
    if len(columns) == 5 and 3 * bits < 64:
        keys = [columns[0] << 2 * bits | columns[1] << bits | columns[2], columns[3] << bits | columns[4]]
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    first = np.flatnonzero(new)
    return [c[order[first]] for c in columns], np.diff(np.r_[first, len(order)])


def placed(columns: list[np.ndarray], hashes: np.ndarray, heavy: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each suffix, and how many of its first words are too frequent to be a group's prefix alone.

    ``hashes`` are those of the words by number, ``heavy`` whether more suffixes start with a word than a group has.
    """
    steps, on = np.zeros(len(columns[0]), "u1"), np.ones(len(columns[0]), bool)
    by, open_ = np.zeros(len(columns[0]), "u8"), on
    for column in columns:
        there = open_ & (column > 0)
        by = np.where(there, mix(by * _STEP + hashes[column]), by)
        on = there & heavy[column]
        steps += on
        open_ = on
    return (by % np.uint64(groups)).astype("i4"), steps


def pack(leaf, n: np.ndarray, steps: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The leaves of each group in one piece: how many, their sizes, totals and steps, then their bytes."""
    order = np.argsort(group, kind="stable")
    leaf, n, steps, group = leaf.take(order), n[order].astype("<u4"), steps[order], group[order]
    edges = np.frombuffer(leaf.buffers()[1], "<i4")[leaf.offset : leaf.offset + len(leaf) + 1]
    raw, sizes = memoryview(leaf.buffers()[2] or b""), np.diff(edges).astype("<u4")
    first = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(group)], strict=True):
        parts = [np.array([b - a], "<u4"), sizes[a:b], n[a:b], steps[a:b]]
        yield int(group[a]), b"".join([*(p.tobytes() for p in parts), raw[edges[a] : edges[b]]])


def unpack(packed: list[bytes]) -> tuple:
    """The different leaves of some pieces in the order of their bytes, their totals, and their steps."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes, totals, steps, raws = [], [], [], []
    for piece in packed:
        k = int.from_bytes(piece[:4], "little")
        sizes.append(np.frombuffer(piece, "<u4", k, 4))
        totals.append(np.frombuffer(piece, "<u4", k, 4 + 4 * k))
        steps.append(np.frombuffer(piece, "u1", k, 4 + 8 * k))
        raws.append(memoryview(piece)[4 + 9 * k :])
    edges = np.r_[0, np.cumsum(np.concatenate(sizes), dtype="i8")]
    buffers = [None, pa.py_buffer(edges.astype("<i8")), pa.py_buffer(b"".join(raws))]
    coded = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, buffers).dictionary_encode()
    number, leaves = coded.indices.to_numpy(), coded.dictionary
    n = np.zeros(len(leaves), "i8")
    np.add.at(n, number, np.concatenate(totals).astype("i8"))
    step = np.zeros(len(leaves), "u1")
    step[number] = np.concatenate(steps)
    order = pc.array_sort_indices(leaves).to_numpy()
    return leaves.take(order), n[order], step[order]


def leaves_of(
    docs: DataFrame, codes: Broadcast, name: str, frequent: Marked, heavy: np.ndarray, groups: int, s: Settings
) -> DataFrame:
    """``place`` (a group) and ``leaves`` (its leaves of a run of texts)."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        coder = held_in_worker(name, lambda: Codes(*codes.value))
        for batch in small(batches, 2_000):
            for lang, words, row in runs_of(batch):
                hashes = word_hashes(lang, words)
                row = np.where(np.r_[False, frequent.has(hashes)][row], row, 0)
                columns, n = added_up(suffixes(row, s.longest))
                if not len(n):
                    continue
                place, steps = placed(columns, np.r_[np.uint64(0), hashes], np.r_[False, np.isin(hashes, heavy)], groups)
                coded = pa.array([b"", *coder.of(words)], pa.binary())
                parts = [pa.repeat(pa.scalar(coder.of_lang(lang.encode()), pa.binary()), len(n))]
                parts += [coded.take(pa.array(c)) for c in columns]
                leaf = pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary()))
                found = list(pack(leaf, n, steps, place))
                for a in range(0, len(found), 10_000):
                    part = found[a : a + 10_000]
                    arrays = [pa.array([x for x, _ in part], pa.int32()), pa.array([y for _, y in part], pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, ["place", "leaves"])

    return rows_of(docs).mapInArrow(run, "place int, leaves binary")


def nodes_of(leaf, n: np.ndarray, steps: np.ndarray, s: Settings) -> Iterator[tuple[bytes, int]]:
    """The nodes over a group's leaves, and the totals of the leaves below each.

    Of nodes that are in no other group, those below ``s.least`` are left out.
    """
    raw = np.frombuffer(leaf.buffers()[2], "u1")
    edges = np.frombuffer(leaf.buffers()[1], "<i8")[leaf.offset : leaf.offset + len(leaf) + 1]
    start, end, other, new = edges[:-1], edges[1:], {}, np.zeros(len(n), bool)
    new[0] = True
    for depth, (a, b) in enumerate(parts_of(raw, start, end, s.longest + 1)):
        there = b > a
        first = np.where(there, raw[np.minimum(a, len(raw) - 1)], 0)
        part = np.full(len(n), -1)
        short = np.flatnonzero(there & (first >= 128))
        x = a[short]
        part[short] = (raw[x].astype("i8") << 16) + (raw[x + 1].astype("i8") << 8) + raw[x + 2]
        for k in np.flatnonzero(there & (first < 128)).tolist():
            part[k] = other.setdefault(raw[a[k] : b[k]].tobytes(), (1 << 30) + len(other))
        new = new.copy()
        new[1:] |= part[1:] != part[:-1]
        if depth < s.shortest:
            continue
        row = np.flatnonzero(there)
        if not len(row):
            return
        heads = np.flatnonzero(new[row])
        total = np.add.reduceat(n[row], heads)
        kept = (total >= s.least) | (steps[row[heads]] >= depth)
        for head, count in zip(row[heads[kept]].tolist(), total[kept].tolist(), strict=True):
            yield raw[start[head] : b[head]].tobytes(), count


def phrase_counts(leaves: DataFrame, codes: Broadcast, name: str, s: Settings) -> DataFrame:
    """``lang``, ``phrase`` and ``f`` of the phrases of ``s.shortest`` words or more that occur ``s.least`` times."""

    def subtrees(batches):
        import pyarrow as pa

        def told(packed):
            found = list(nodes_of(*unpack(packed), s))
            nodes = [pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.int64())]
            return pa.RecordBatch.from_arrays(nodes, ["node", "n"])

        place, held = None, []
        for batch in small(batches):
            for group, packed in zip(batch.column("place").to_pylist(), batch.column("leaves").to_pylist(), strict=True):
                if group != place and held:
                    yield told(held)
                    held = []
                place = group
                held.append(packed)
        if held:
            yield told(held)

    def spelled(batches):
        import pyarrow as pa

        coder = held_in_worker(name, lambda: Codes(*codes.value))
        for batch in small(batches):
            rows = [coder.read(x) for x in batch.column("node").to_pylist()]
            columns = [pa.array([x[0] for x in rows], pa.binary()), pa.array([b" ".join(x[1:]) for x in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays([*(c.cast(pa.string()) for c in columns), batch.column("f")], ["lang", "phrase", "f"])

    dealt = leaves.repartition("place").sortWithinPartitions("place")
    nodes = dealt.mapInArrow(subtrees, "node binary, n long").groupBy("node").agg(F.sum("n").alias("f"))
    return nodes.filter(F.col("f") >= s.least).mapInArrow(spelled, "lang string, phrase string, f long")


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame, s: Settings) -> DataFrame:
    """The first ``s.top`` collocations of each language.

    ``phrases`` and ``words`` have ``lang``, ``phrase`` and ``f``; ``totals`` has ``lang`` and ``n``.
    """
    parts = phrases.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("words"))
    size = F.size("words")
    cuts = parts.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    first, rest = F.slice("words", F.lit(1), F.col("k")), F.slice("words", F.col("k") + 1, size - F.col("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(first, " ").alias("first"), F.array_join(rest, " ").alias("rest"))
    both = phrases.unionByName(words)
    cuts = cuts.join(both.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(both.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    whole = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    cuts = cuts.join(totals, "lang").select("*", *(x.alias(f"{c}_") for c, x in whole.items()))
    score = F.expr("cast(1000 as decimal(4,0)) * a_ * n_ div (l_ * r_)")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("least")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(least)
    # what lies inside a longer candidate, one word off either end at a time
    inner = F.explode(F.sequence(F.lit(s.shortest), size - 1)).alias("m")
    inside = parts.filter(size > s.shortest).select("lang", "a", "words", inner)
    inside = inside.select("lang", "a", "m", "words", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("at"))
    inside = inside.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("m")), " ").alias("phrase"), "a")
    around = inside.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    covered = 100 * F.coalesce("around", F.lit(0)) >= s.share_percent * F.col("a")
    kept = best.join(around, ["lang", "phrase"], "left").filter(~covered)
    order = Window.partitionBy("lang").orderBy(F.desc("least.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= s.top)
    return ranked.select("lang", "rank", "phrase", "a", "least.l", "least.r", "n", "least.score")


def collocations(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """The first ``s.top`` phrases of each language by score: ``lang``, ``rank``, ``phrase``, ``a`` (its count), ``l`` and
    ``r`` (those of the parts of its worst cut), ``n`` (all words of the language) and ``score``."""
    s, spark = s or Settings(), docs.sparkSession
    words = written(word_counts(docs), "phrase-words")
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    n = totals.agg(F.sum("n")).first()[0] or 0
    leaves = max(s.leaves, -(-2 * n // s.groups))
    groups = max(1, -(-2 * n // leaves))
    langs = [r.lang.encode() for r in totals.orderBy(F.desc("n"), "lang").limit(1_000).collect()]
    codes, name = spark.sparkContext.broadcast((_most_frequent(words, s), langs)), f"phrase-codes-{uuid.uuid4().hex}"
    enough = words.filter(F.col("n") >= s.least)
    key = F.xxhash64("lang", "word").alias("key")
    heavy = np.array([r.key for r in words.filter(F.col("n") > leaves).select(key).collect()], "i8").view("u8")
    found = leaves_of(docs, codes, name, Marked(enough.select(key), "key"), heavy, groups, s)
    phrases = written(phrase_counts(found, codes, name, s), "phrases")
    single = enough.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f"))
    return scored(phrases, single, totals, s)


def _most_frequent(words: DataFrame, s: Settings) -> list[bytes]:
    """At most ``s.coded`` words of all languages, the most frequent, by a threshold from a histogram of their counts."""
    rows = words.filter((F.col("n") >= s.least) & (F.octet_length("word") <= s.word_bytes)).groupBy("word").agg(F.max("n").alias("n"))
    rows = rows.select("word", F.floor(16 * F.log2("n")).cast("int").alias("size"))
    room, least = s.coded, None
    for step in rows.groupBy("size").count().orderBy(F.desc("size")).collect():
        room -= step["count"]
        if room < 0:
            break
        least = step["size"]
    return [] if least is None else [r.word.encode() for r in rows.filter(F.col("size") >= least).orderBy("word").collect()]
