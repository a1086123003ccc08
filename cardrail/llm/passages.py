"""Repeated passages: sparse suffix arrays over minimiser positions.

A passage is a run of ``length`` words that occurs in two documents or more. Of the runs of ``k`` words in every such
window the one of least hash is its minimiser: equal windows select it at equal places, so only the suffixes that start
at minimisers are retained. A retained suffix carries a hash for each window that selected it, that is, for the suffix
extended ``l`` words to the left and ``length - l`` to the right, for every ``l`` it is answerable for. In a text that repeats with a period, like ones follow at equal distances; they are one row that says how
many and how far apart they are.

1. The first words of the retained suffixes are counted. Those that two documents have, and those that very many suffixes
   have, are marked in filters of a fixed size; suffixes without a mark go no further, and are never shuffled.
2. The others meet by their first words and are sorted in each extension; equal neighbours are occurrences of one
   window. First words that very many suffixes share are not brought together: equal suffixes are added up first, and
   their extensions meet one by one.
3. Matched windows that overlap are joined: matches are extended left and right as far as they go.

Words are what stands between white space, in lower case. Of a window's occurrences the first is the one in the
document of smallest id; ``drop_repeats`` takes it out of all others.

Defined results: null, empty and short texts hold no passage; a passage that repeats within one document only is none;
rows with a null ``doc_id`` take no part and stay as they are; rows with the same id are one document, and each row's
text is looked at and cut on its own; an empty table gives an empty result; other columns are left out by ``repeats``
and kept by ``drop_repeats``, which sets ``n_chars`` if it is there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardrail.llm.common import Marked, discard, fresh, slices, small, written
from cardrail.llm.ngrams import mix, runs, words_in_worker

SUFFIX_SCHEMA = "key long, apart boolean, doc_id long, tag long, at long, again long, ends binary"
HIT_SCHEMA = "doc_id long, tag long, first_window int, last_window int, first_doc_id long"

#: Suffixes compared at a time by a task.
CHUNK = 100_000


@dataclass(frozen=True)
class Settings:
    length: int = 50
    k: int = 8
    #: First words that more suffixes share than this meet by extension.
    together: int = 10_000

    def __post_init__(self):
        if not 0 < self.k <= self.length <= self.k + 255:
            raise ValueError("a passage has 0 to 255 words more than its k first words")


def text_tag(text: str = "text") -> Column:
    """64 bits that tell the texts of rows with the same id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def retained(texts: list[str], s: Settings) -> tuple[np.ndarray, ...]:
    """The retained suffixes of some texts.

    Of each: the text's number, the key, the place, how far it reaches to the left, how many like it follow (with it)
    and how far apart, and how many windows it has; then the windows' hashes, all in a row, from the farthest left on.
    """
    words = [words_in_worker().hashes(t) for t in texts]
    sizes = np.array([len(w) for w in words])
    starts = np.cumsum(sizes) - sizes
    joined = np.concatenate(words) if words else np.zeros(0, "u8")
    text = np.repeat(np.arange(len(texts)), sizes)
    fits = np.arange(len(joined)) + s.length <= np.repeat(starts + sizes, sizes)
    window = np.flatnonzero(fits)
    if not len(window):
        none = np.zeros(0, int)
        return none, none.astype("u8"), none, none, none, none, none, none.astype("u8")
    grams, span = runs(joined, s.k), s.length - s.k + 1
    views = np.lib.stride_tricks.sliding_window_view(grams, span)
    at = np.concatenate([w + views[w].argmin(axis=1) for w in np.array_split(window, 1 + len(window) // 20_000)])
    new = np.r_[True, (at[1:] != at[:-1]) | (text[window[1:]] != text[window[:-1]])]
    first = np.flatnonzero(new)
    number = text[window[first]]
    count = np.diff(np.r_[first, len(window)])
    whole = runs(joined, s.length)[window]
    place, left = at[first], at[first] - window[first]
    # like the one before it, and as far from it as that one is from its own
    content = np.add.reduceat(mix(whole + (np.arange(len(window)) - np.repeat(first, count)).astype("u8")), first)
    like = np.ones(len(first), bool)
    for column in (number, left, count, content):
        like[1:] &= column[1:] == column[:-1]
    gap = np.diff(place, prepend=place[0])
    like[0] = False
    head = ~like
    head[1:] |= like[:-1] & (gap[1:] != gap[:-1])
    some = np.flatnonzero(head)
    times = np.diff(np.r_[some, len(head)])
    apart = np.where(times > 1, gap[np.minimum(some + 1, len(gap) - 1)], 0)
    hashes = whole[np.repeat(head, count)]
    number, place = number[some], place[some]
    return number, grams[place], place - starts[number], left[some], times, apart, count[some], hashes


def suffixes(docs: DataFrame, s: Settings, shared: Marked | None = None, many: Marked | None = None) -> DataFrame:
    """``key`` and ``doc_id`` of every retained suffix. With ``shared``, of those whose key it has; also ``apart`` (whether
    ``many`` has the key), ``tag`` (of the text), ``at`` (place, reach to the left), ``again`` (how many, how far apart) and
    ``ends`` (its windows' hashes). A narrow pass."""

    def run(batches):
        import pyarrow as pa

        for batch in small(batches):
            doc_ids, tags = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy()
            a = 0
            for texts in slices(batch.column("text").to_pylist()):
                number, key, place, left, times, apart, count, hashes = retained(texts, s)
                if not shared:
                    columns, names = [pa.array(key.view("i8")), pa.array(doc_ids[a + number])], ["key", "doc_id"]
                else:
                    kept = shared.has(key)
                    hashes = hashes[np.repeat(kept, count)]
                    number, key, place, left, times, apart, count = (x[kept] for x in (number, key, place, left, times, apart, count))
                    edges = pa.array(8 * np.r_[0, np.cumsum(count)], pa.int32())
                    ends = pa.Array.from_buffers(pa.binary(), len(count), [None, edges.buffers()[1], pa.py_buffer(hashes)])
                    own = [doc_ids[a + number], tags[a + number], place << 8 | left, times << 8 | apart]
                    columns = [pa.array(x) for x in (key.view("i8"), many.has(key), *own)] + [ends]
                    names = ["key", "apart", "doc_id", "tag", "at", "again", "ends"]
                yield pa.RecordBatch.from_arrays(columns, names)
                a += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_tag().alias("tag"), "text")
    rows = rows.filter("doc_id is not null and text is not null")
    return rows.mapInArrow(run, SUFFIX_SCHEMA if shared else "key long, doc_id long")


def neighbours(key: np.ndarray, doc_id: np.ndarray, left: np.ndarray, count: np.ndarray, hashes: np.ndarray):
    """For each window of some suffixes whether another document has it, and the smallest id that has it.

    The suffixes are sorted in each of their extensions, by key, reach to the left and hash of the whole window.
    """
    row = np.repeat(np.arange(len(key)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    reach = left[row] - step
    order = np.lexsort((hashes, reach, key[row]))
    sorted_ = (key[row][order], reach[order], hashes[order])
    new = np.r_[True, np.any([c[1:] != c[:-1] for c in sorted_], axis=0)]
    first = np.flatnonzero(new)
    ids = doc_id[row][order]
    low, high = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
    group = np.empty(len(row), int)
    group[order] = np.cumsum(new) - 1
    return row, step, low[group] < high[group], low[group]


def _tables(batches, rows: int) -> Iterator:
    """The rows of a stream sorted by ``key``, in tables of about ``rows`` that break no key."""
    import pyarrow as pa

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield table.slice(0, cut).combine_chunks()
            held, n = table.slice(cut).to_batches(), table.num_rows - cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _match(batches):
    """Runs of windows that other documents have too, from suffixes sorted by key."""
    import pyarrow as pa

    for table in _tables(batches, CHUNK):
        at = table.column("at").to_numpy()
        ends = table.column("ends").combine_chunks()
        ends = ends.chunk(0) if isinstance(ends, pa.ChunkedArray) else ends
        raw, edges = ends.buffers()[2], np.frombuffer(ends.buffers()[1], "i4")[ends.offset : ends.offset + len(ends) + 1]
        hashes = np.frombuffer(raw, "u1")[edges[0] : edges[-1]].copy().view("u8")
        doc_id, left = table.column("doc_id").to_numpy(), at & 0xFF
        row, step, hit, low = neighbours(table.column("key").to_numpy(), doc_id, left, np.diff(edges) // 8, hashes)
        row, step, low = row[hit], step[hit], low[hit]
        if not len(row):
            continue
        new = np.r_[True, (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1) | (low[1:] != low[:-1])]
        a = np.flatnonzero(new)
        b = np.r_[a[1:], len(row)] - 1
        base = ((at >> 8) - left)[row[a]]
        again = table.column("again").to_numpy()[row[a]]
        # windows nearer than their length cover all words from the first to the last
        far = ((again >> 8) - 1) * (again & 0xFF)
        columns = [doc_id[row[a]], table.column("tag").to_numpy()[row[a]], base + step[a], base + step[b] + far, low[a]]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        names = [f.split()[0] for f in HIT_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True)], names)


def _match_apart(rows: DataFrame) -> DataFrame:
    """The same for keys of any number of suffixes: equal ones are added up, then each extension meets its equals."""
    left = F.col("at").bitwiseAND(F.lit(0xFF)).cast("int")
    rows = rows.select("key", "doc_id", "tag", "at", "again", "ends", left.alias("left"))
    one = ["key", "left", "ends"]
    alike = rows.groupBy(*one).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    steps = F.sequence(F.lit(0), (F.octet_length("ends") / 8).cast("int") - 1)
    spread = alike.select("*", F.explode(steps).alias("step"))
    reach, end = (F.col("left") - F.col("step")).alias("reach"), F.substring("ends", 8 * F.col("step") + 1, F.lit(8)).alias("end")
    spread = spread.select(*one, "low", "high", "step", reach, end)
    found = spread.groupBy("key", "reach", "end").agg(F.min("low").alias("first_doc_id"), F.max("high").alias("last"))
    found = found.filter("first_doc_id < last").drop("last")
    hits = F.collect_list(F.struct("step", "first_doc_id")).alias("hits")
    back = spread.join(found, ["key", "reach", "end"]).groupBy(*one).agg(hits)
    rows = rows.join(back, one).select("doc_id", "tag", "at", "again", "left", F.explode("hits").alias("hit"))
    window = (F.shiftright("at", 8) - F.col("left") + F.col("hit.step")).cast("int")
    far = ((F.shiftright("again", 8) - 1) * F.col("again").bitwiseAND(F.lit(0xFF))).cast("int")
    last = (window + far).alias("last_window")
    return rows.select("doc_id", "tag", window.alias("first_window"), last, "hit.first_doc_id")


def repeats(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """Every maximal run of words, in every row, made of windows that another document has too.

    ``doc_id``, ``tag`` (of the row's text), ``start`` (its first word), ``n_words``, ``first_doc_id`` (the smallest id
    that has one of its windows), and ``kept``: whether its windows occur in this document first. Windows that occur
    here first and others are joined apart.
    """
    s = s or Settings()
    keys = suffixes(docs, s).groupBy("key")
    keys = keys.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    keys = written(keys.filter("low < high").select("key", "n"), "suffix-keys")
    # a key that is marked by chance only costs its suffixes' way: it has no equal windows in two documents
    found = suffixes(docs, s, Marked(keys, "key"), many := Marked(keys.filter(F.col("n") > s.together), "key"))
    discard(keys)
    if not many.empty:
        found = written(found, "suffixes")
    hits = found.filter("not apart").drop("apart").repartition("key").sortWithinPartitions("key").mapInArrow(_match, HIT_SCHEMA)
    if not many.empty:
        hits = hits.unionByName(_match_apart(found.filter("apart")))
    hits = hits.withColumn("kept", F.col("first_doc_id") == F.col("doc_id"))
    one = Window.partitionBy("doc_id", "tag", "kept").orderBy("first_window")
    until = F.max("last_window").over(one.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("first_window") > until + s.length, F.lit(True))
    hits = hits.withColumn("new", new.cast("int")).withColumn("part", F.sum("new").over(one))
    spans = hits.groupBy("doc_id", "tag", "kept", "part").agg(
        F.min("first_window").alias("start"),
        (F.max("last_window") - F.min("first_window") + s.length).alias("n_words"),
        F.min("first_doc_id").alias("first_doc_id"),
    )
    return spans.select("doc_id", "tag", "start", "n_words", "first_doc_id", "kept")


WORD = re.compile(r"\S+")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without some runs of words (first word, number of words), and without the white space before each."""
    words = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for start, n in sorted(spans):
        a, b = words[start - 1][1] if start else 0, words[start + n - 1][1]
        out.append(text[at : max(at, a)])
        at = max(at, b)
    return "".join([*out, text[at:]]).strip()


def drop_repeats(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """``docs`` with every repeated passage taken out of all documents but the one of smallest id; no row is dropped."""
    tag, doc_id, own, cuts = fresh(docs, "text_tag", "cut_doc_id", "cut_tag", "cuts")
    spans = repeats(docs, s).filter("not kept").groupBy(F.col("doc_id").alias(doc_id), F.col("tag").alias(own))
    spans = written(spans.agg(F.collect_list(F.struct("start", "n_words")).alias(cuts)), "cuts")
    # rows without a cut stay where they are; the others meet their cuts in a stage of their own, with one worker a task
    some = Marked(spans.select(F.xxhash64(doc_id, own).alias("key")), "key")
    rows, others = some.divided(docs.withColumn(tag, text_tag()), F.xxhash64(F.col("doc_id").cast("long"), tag))
    same = (F.col("doc_id").cast("long") == F.col(doc_id)) & (F.col(tag) == F.col(own))
    joined = rows.join(spans.hint("merge"), same, "left")
    fields = docs.schema.names

    def run(batches):
        import pyarrow as pa

        for batch in small(batches):
            texts = [
                t if not c or t is None else without(t, [(x["start"], x["n_words"]) for x in c])
                for t, c in zip(batch.column("text").to_pylist(), batch.column(cuts).to_pylist(), strict=True)
            ]
            columns = {name: batch.column(name) for name in fields}
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                sizes = [None if t is None else len(t) for t in texts]
                columns["n_chars"] = pa.array(sizes, pa.int64()).cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=fields)

    return joined.select(*fields, cuts).mapInArrow(run, docs.schema).unionByName(others.select(*fields))
