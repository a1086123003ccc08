"""Collocations against counting every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardrail.llm import phrases

SCHEMA = "doc_id long, text string, lang string, n long, phrase string, words string"


def by_force(rows, s):
    """Every phrase counted in dictionaries, and the rules applied one by one."""
    total, counts = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, s.longest + 1):
                    if i + m <= len(words):
                        counts[lang, tuple(words[i : i + m])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) >= 2 and a >= s.least}
    covered = set()
    for (lang, words), a in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if 100 * a >= s.share_percent * counts[lang, words[i : i + m]]:
                    covered.add((lang, words[i : i + m]))
    found = {}
    for (lang, words), a in candidates.items():
        if (lang, words) in covered:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, listed in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[: s.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def documents(seed=1, size=400):
    draw = random.Random(seed)
    vocabulary = ["The", "of", "a", "a\x01", "a!b", "été", "Été", "日本", "x" * 90, "\x00", "in", "to", "fox", "dog", "sun", "y" * 300]
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", " ; ", "!"]
    rows = []
    for i in range(size):
        text = "".join(draw.choice(vocabulary) + draw.choice(marks) for _ in range(draw.randint(0, 60)))
        if i % 5 == 0:
            text += " one long passage that is everywhere. the end "
        rows.append((text, draw.choice(["en", "en", "fr", None, "und", "de"])))
    return rows + [(None, "en"), ("", "fr"), ("...", "es"), ("word " * 5_000, "en"), ("of the " * 3_000, "long" * 50)] + rows[:3]


def frame(spark, rows):
    return spark.createDataFrame([(i % 7, t, lang, 1, "p", "w") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(5)


@pytest.mark.parametrize(
    "s",
    [
        phrases.Settings(least=5),
        phrases.Settings(least=5, leaves=50, groups=1 << 10, coded=4, top=20),
        phrases.Settings(least=3, share_percent=60, leaves=300),
    ],
    ids=["whole", "small groups", "share"],
)
def test_collocations_equal_brute_force(spark, s):
    rows = documents()
    found = phrases.collocations(frame(spark, rows), s)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got, want = sorted(map(tuple, found.collect())), by_force(rows, s)
    assert len(want) > 50 and got == want


def test_collocations_of_nothing(spark):
    docs = frame(spark, documents())
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.filter("text is null or text = ''")).count() == 0
    assert phrases.collocations(docs.limit(3), phrases.Settings(least=10**6)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**12
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big + 1)], "lang string, phrase string, f long")
    pairs = spark.createDataFrame([("en", "a b", big - 7)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 2 * 10**13 + 1)], "lang string, n long")
    (row,) = phrases.scored(pairs, words, totals, phrases.Settings()).collect()
    assert row.score == 1000 * (big - 7) * (2 * 10**13 + 1) // (big * (big + 1))


def test_groups_divide_frequent_prefixes():
    draw = np.random.default_rng(4)
    # words 1 and 2 are too frequent for a group; rows end with zeros
    rows = draw.choice([1, 1, 1, 2, 2, 3, 4, 5], (2_000, 5))
    rows[np.arange(5)[None, :] >= draw.integers(2, 6, 2_000)[:, None]] = 0
    hashes, heavy = draw.integers(1, 1 << 62, 6).astype("u8"), np.array([0, 1, 1, 0, 0, 0], bool)
    place, steps = phrases.placed(list(rows.T), hashes, heavy, 64)
    groups = {}
    for row, group, step in zip(rows.tolist(), place.tolist(), steps.tolist(), strict=True):
        words = [w for w in row if w]
        leading = next((k for k, w in enumerate(words) if w > 2), len(words))
        assert step == leading
        # the suffixes of a prefix that ends with a word that is not too frequent are in one group
        if leading < len(words):
            groups.setdefault(tuple(words[: leading + 1]), set()).add(group)
    assert len(groups) > 20 and all(len(x) == 1 for x in groups.values())
    assert len(set(place.tolist())) > 40


def test_word_hashes_are_those_of_spark(spark):
    words = ["", "a", "word", "é日本", "x" * 31, "y" * 32, "z" * 1000, "nine bytes"]
    rows = spark.createDataFrame([(lang, w) for lang in ("en", "") for w in words], "lang string, word string")
    for lang in ("en", ""):
        want = [r.h for r in rows.filter(F.col("lang") == lang).select(F.xxhash64("lang", "word").alias("h")).collect()]
        assert phrases.word_hashes(lang, [w.encode() for w in words]).view("i8").tolist() == want


def test_leaves_are_packed_and_added_up():
    import pyarrow as pa

    leaf, n, steps = pa.array([b"b", b"aa", b"b", b"", b"c" * 300]), np.array([1, 2, 3, 4, 5]), np.array([0, 1, 0, 2, 0], "u1")
    packed = dict(phrases.pack(leaf, n, steps, np.array([7, 3, 7, 3, 7], "i4")))
    assert sorted(packed) == [3, 7]
    found = [phrases.unpack([packed[k], packed[k]]) for k in (3, 7)]
    assert [x[0].to_pylist() for x in found] == [[b"", b"aa"], [b"b", b"c" * 300]]
    assert [x[1].tolist() for x in found] == [[8, 4], [8, 10]] and [x[2].tolist() for x in found] == [[2, 1], [0, 0]]


def test_codes_tell_where_they_end():
    coder = phrases.Codes([b"the", b"of"], [b"en"])
    words = [b"the", b"zzz", b"x" * 126, b"y" * 127, b"z" * 70_000, b"of"]
    raw = [coder.of_lang(b"en") + b"".join(coder.of(words[:k])) for k in range(len(words))]
    assert [coder.read(r) for r in raw] == [[b"en", *words[:k]] for k in range(len(words))]
    joined, size = np.frombuffer(b"".join(raw), "u1"), np.cumsum([0, *map(len, raw)])
    parts = list(phrases.parts_of(joined, size[:-1], size[1:], 6))
    for k, row in enumerate(raw):
        cuts = [joined[a[k] : b[k]].tobytes() for a, b in parts]
        assert b"".join(cuts) == row and sum(map(bool, cuts)) == k + 1
