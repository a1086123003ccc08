"""N-gram Jaccard join: MinHash banding, and every candidate pair verified on its full n-gram sets.

A text is the set of its runs of ``n`` words (a shorter text with words is one run). Rows and bands of the MinHash
signature follow from the threshold, the recall wanted at it, and the number of hashes allowed. Work is done on different
texts; copies are counted.

1. One pass over the texts makes band hashes, which are shuffled; a band hash that two texts share is a bucket.
   Buckets of the same texts are one.
2. The texts in buckets are fetched and turned into sets. A bucket of many texts, or of very long ones, is dealt out as
   pairs of blocks, each a bounded task of its own. A task compares its sets by counting shared n-grams, and reports for
   each text how many texts it is linked with, and a tree that spans each linked group, but no pairs. A pair that meets
   in several buckets counts in the first of them.
3. Linked groups are joined into classes.

Defined results: a text without words (null, empty, blank) has no n-grams, stands alone and links with nothing, not even
its copies; other equal texts link whatever their length. Rows come out as often as they come in; rows that repeat an id
are documents of their own. A null ``doc_id`` is in a class like any other, and names one only if all ids in it are null.
An empty table gives an empty result. Other columns are left out by ``classes`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardrail.llm.common import fresh, small, written
from cardrail.llm.components import components
from cardrail.llm.ngrams import mix, runs, words_in_worker

#: What a block of a bucket holds about, in n-grams and in texts.
BLOCK_NGRAMS, BLOCK_TEXTS = 1_000_000, 2_048

#: Shares of texts up to this size are counted pair by pair, larger ones by a matrix product.
SPARSE = 24


def bands_for(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """Bands and rows in each: the most rows for which so many bands as reach ``recall`` at ``threshold`` are allowed.

    A pair of similarity s shares a band with probability 1 - (1 - s**rows)**bands.
    """
    found = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= most_hashes:
            found = (bands, rows)
    return found


@dataclass(frozen=True)
class Settings:
    n: int = 5
    threshold: float = 0.8
    recall: float = 0.9995
    seed: int = 3

    def bands(self) -> tuple[int, int]:
        return bands_for(self.threshold, self.recall)


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """The different n-grams of a text as hashes, ascending."""
    words = words_in_worker().hashes(text)
    return np.unique(runs(words, min(n, len(words)))) if len(words) else words


class MinHash:
    def __init__(self, s: Settings):
        self.bands, self.rows = s.bands()
        draw = np.random.default_rng(s.seed)
        size = self.bands * self.rows
        self.flip = draw.integers(0, 2**63, size, "u8") * np.uint64(2) + draw.integers(0, 2, size, "u8")
        self.times = draw.integers(0, 2**63, size, "u8") * np.uint64(2) + np.uint64(1)

    def band_hashes(self, ngrams: np.ndarray) -> np.ndarray:
        least = np.full(len(self.flip), np.iinfo("u8").max, "u8")
        for a in range(0, len(ngrams), 4096):
            part = ngrams[a : a + 4096, None]
            least = np.minimum(least, ((part ^ self.flip) * self.times).min(axis=0))
        out = np.arange(1, self.bands + 1, dtype="u8")
        for row in least.reshape(self.bands, self.rows).T:
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + row)
        return out


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two sets have in common.

    A member that few sets hold adds to each pair of them; one that few sets lack adds to all pairs but those; the rest
    go through a matrix product, some columns at a time.
    """
    m = len(sets)
    out = np.zeros(m * m, "i4")
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, int)
    sizes = np.diff(np.r_[first, len(values)])
    held = sizes <= min(SPARSE, m / 2)
    lacked = ~held & (m - sizes <= SPARSE)

    def add_pairs(rows: np.ndarray) -> None:
        """Adds one for each pair in each row."""
        cells = (rows[:, :, None] * m + rows[:, None, :]).ravel()
        if m * m <= 4 * len(cells):
            out[:] += np.bincount(cells, minlength=m * m).astype("i4")
        else:
            cell, times = np.unique(cells, return_counts=True)
            out[cell] += times.astype("i4")

    def parts(chosen: np.ndarray, width: int) -> Iterator[np.ndarray]:
        """The holders of each chosen member, some rows at a time; all have as many."""
        starts, step = first[chosen], max(1, 4_000_000 // max(1, width))
        for a in range(0, len(starts), step):
            yield owner[starts[a : a + step, None] + np.arange(sizes[chosen[0]])]

    for size in np.unique(sizes[held]).tolist():
        for holders in parts(np.flatnonzero(held & (sizes == size)), size * size):
            add_pairs(holders)
    lack = np.zeros(m, "i4")
    for size in np.unique(sizes[lacked]).tolist():
        if size < m:
            for holders in parts(np.flatnonzero(lacked & (sizes == size)), m + (m - size) ** 2):
                absent = np.ones((len(holders), m), bool)
                absent[np.arange(len(holders))[:, None], holders] = False
                rows = np.nonzero(absent)[1].reshape(len(holders), m - size)
                lack += np.bincount(rows.ravel(), minlength=m).astype("i4")
                add_pairs(rows)
    out = out.reshape(m, m)
    out += np.int32(lacked.sum()) - lack[:, None] - lack[None, :]
    rest = np.flatnonzero(~held & ~lacked)
    step = max(1, 8_000_000 // m)
    for a in range(0, len(rest), step):
        columns = np.zeros((m, min(step, len(rest) - a)), "f4")
        for column, i in enumerate(rest[a : a + step]):
            columns[owner[first[i] : first[i] + sizes[i]], column] = 1
        out += (columns @ columns.T).astype("i4")
    return out


def groups_of(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row it is connected with."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked_in_block(
    sets: list[np.ndarray], before: list[np.ndarray], side: np.ndarray, across: bool, threshold: float
) -> np.ndarray:
    """Which rows of a block (or across two) are linked, and met in no bucket ``before`` this one."""
    size = np.array([len(s) for s in sets])
    shared = shared_counts(sets)
    linked = shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-9
    np.fill_diagonal(linked, False)
    if across:
        linked &= side[:, None] != side[None, :]
    if linked.any() and any(map(len, before)):
        linked &= shared_counts(before) == 0
    return linked


def grouped(batches, keys: int) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of each key of a sorted stream of record batches; the key is in the first ``keys`` columns."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            found = tuple(row.values())[:keys]
            if found != key:
                if rows:
                    yield key, rows
                key, rows = found, []
            rows.append(row)
    if rows:
        yield key, rows


def digest(text: str = "text") -> Column:
    """128 bits that name a text."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc_id``, ``digest``, number of n-grams and band hashes of every row, stored. A narrow pass."""

    def run(batches):
        import pyarrow as pa

        hasher = MinHash(s)
        for batch in small(batches):
            sizes, bands, known = [], [], {}
            for name, text in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if name not in known:
                    ngrams = ngram_set(text, s.n)
                    known[name] = len(ngrams), hasher.band_hashes(ngrams).view("i8") if len(ngrams) else []
                sizes.append(known[name][0])
                bands.append(known[name][1])
            columns = [batch.column("doc_id"), batch.column("digest")]
            columns += [pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "size", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest"), "text")
    return written(rows.mapInArrow(run, "doc_id long, digest binary, size long, bands array<long>"), "signatures")


def buckets(texts: DataFrame) -> DataFrame:
    """``bucket``, its number of blocks, and ``digest`` of the texts in it, for buckets of two texts or more."""
    entries = texts.select("digest", "size", F.explode("bands").alias("bucket"))
    name = F.xxhash64("digest")
    whole = entries.groupBy("bucket").agg(
        F.count("*").alias("texts"),
        F.sum("size").alias("ngrams"),
        F.bit_xor(name).alias("mark"),
        F.bit_xor(F.xxhash64("digest", F.lit(1))).alias("mark2"),
    )
    blocks = F.ceil(F.greatest(F.col("ngrams") / BLOCK_NGRAMS, F.col("texts") / BLOCK_TEXTS)).cast("int")
    kept = whole.filter("texts >= 2").groupBy("texts", "ngrams", "mark", "mark2").agg(F.min("bucket").alias("bucket"))
    return entries.drop("size").join(kept.select("bucket", blocks.alias("blocks")), "bucket")


def compare(docs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """``digest``, ``links`` and ``root``: what each task found for the texts in a block of a bucket."""
    shared = F.sort_array(F.collect_list(F.struct("bucket", "blocks"))).alias("shared")
    met = buckets(texts).groupBy("digest").agg(shared).join(texts.select("digest", "rep", "copies"), "digest")
    own = docs.select(F.col("doc_id").cast("long").alias("rep"), digest().alias("digest"), "text")
    same = own["digest"].eqNullSafe(met["digest"]) & own["rep"].eqNullSafe(met["rep"])
    found = own.join(met, same).select(met["digest"], "copies", "shared", "text").dropDuplicates(["digest"])

    def to_sets(batches):
        import pyarrow as pa

        for batch in small(batches):
            sets = pa.array([ngram_set(t, s.n).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("digest", "copies", "shared")), sets], ["digest", "copies", "shared", "ngrams"]
            )

    schema = "digest binary, copies long, shared array<struct<bucket: long, blocks: int>>, ngrams binary"
    sets = written(found.mapInArrow(to_sets, schema), "ngram-sets")
    at = F.explode("shared").alias("at")
    rows = sets.select("digest", "copies", "ngrams", F.transform("shared", lambda x: x["bucket"]).alias("met"), at)
    side = F.pmod(F.xxhash64("digest"), F.col("at.blocks")).cast("int")
    rows = rows.select("*", F.col("at.bucket").alias("bucket"), side.alias("side"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("at.blocks") - 1)).alias("other"))
    low, high = F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
    keys = ["bucket", "low", "high"]
    rows = rows.select("bucket", low, high, "side", "digest", "copies", "met", "ngrams")

    def verify(batches):
        import pyarrow as pa

        for (bucket, low, high), members in grouped(batches, 3):
            if len(members) < 2:
                continue
            linked = linked_in_block(
                [np.frombuffer(m["ngrams"], "u8") for m in members],
                [np.array([b for b in m["met"] if b < bucket], "i8").view("u8") for m in members],
                np.array([m["side"] for m in members]),
                low != high,
                s.threshold,
            )
            some = np.flatnonzero(linked.any(axis=1))
            if len(some):
                links = linked[some] @ np.array([m["copies"] for m in members])
                names, label = [m["digest"] for m in members], groups_of(linked)
                columns = [[names[i] for i in some], links.tolist(), [names[label[i]] for i in some]]
                arrays = [pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int64(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["digest", "links", "root"])

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return written(dealt.mapInArrow(verify, "digest binary, links long, root binary"), "near-links")


def text_classes(docs: DataFrame, s: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and of each different text with words: class, links, copies, and the smallest id
    in the class (``class_id``) with the text that has it (``first``)."""
    s = s or Settings()
    signed = signatures(docs, s)
    texts = signed.filter("size > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    texts = written(texts, "texts")
    found = compare(docs, texts, s)
    roots = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    texts = texts.drop("bands", "size").join(links, "digest", "left")
    texts = texts.join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    texts = texts.withColumn("root", F.coalesce("root", "digest"))
    # the smallest id names a class, nulls last
    first = F.min(F.struct(F.col("rep").isNull(), F.col("rep"), F.col("digest"))).alias("least")
    named = texts.groupBy("root").agg(first).select("root", F.col("least.rep").alias("class_id"), F.col("least.digest").alias("first"))
    count = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    return signed, written(texts.join(named, "root").select("digest", "class_id", "first", count.alias("n_links")), "classes")


def classes(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """``doc_id``, ``class_id`` and ``n_links`` of every row: the smallest id among the texts it is connected with by
    links, and how many other rows it links with directly."""
    signed, texts = text_classes(docs, s)
    found = signed.select("doc_id", "digest").join(texts, "digest", "left")
    alone = F.col("n_links").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def worded(text: str = "text") -> Column:
    """Whether a text has words, as ``signatures`` counts them: by all that ``str.split`` takes for white space."""
    blank = "".join(rf"\u{i:04x}" for i in range(0x10000) if chr(i).isspace())
    return F.coalesce(F.col(text).rlike(f"[^{blank}]"), F.lit(False))


def one_of_each(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: of each class the row of the smallest id.

    If that row is repeated, the first by its other columns stays.
    """
    _, texts = text_classes(docs, s)
    name, named, key, again = fresh(docs, "digest", "class_id", "class_first", "again")
    firsts = texts.filter("digest = first").select(F.col("digest").alias(key), F.col("class_id").alias(named))
    rows = docs.withColumn(name, digest())
    same = (F.col(name) == F.col(key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(named))
    order = Window.partitionBy(name, named).orderBy(*(c for c in docs.columns if c != "text"))
    kept = rows.join(firsts, same).withColumn(again, F.row_number().over(order)).filter(F.col(again) == 1)
    return kept.select(*docs.columns).unionByName(docs.filter(~worded()))
