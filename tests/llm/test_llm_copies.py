"""Near copies, repeated passages and components against brute force."""

import itertools
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardrail.llm import near_copies, ngrams, passages
from cardrail.llm.components import components

SCHEMA = "doc_id long, text string, digest string, class_id int, bands string, cuts int, n_chars long, text_tag int"


def frame(spark, rows):
    full = [(i, t, "x", 1, "y", 2, None if t is None else len(t), 3) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def words(draw, n):
    return [f"w{draw.randrange(4000)}" for _ in range(n)]


def changed(draw, text, times):
    text = list(text)
    for _ in range(times):
        text[draw.randrange(len(text))] = f"new{draw.randrange(10**6)}"
    return text


@pytest.fixture(scope="module")
def rows():
    draw, out = random.Random(8), []
    for _ in range(40):
        out.append(words(draw, draw.randrange(1, 300)))
    for size in (2, 3, 9, 80):
        base = words(draw, 150)
        out += [changed(draw, base, draw.randrange(6)) for _ in range(size)]
    out += [out[0]] * 6 + [["few", "words"]] * 3 + [["Few", "WORDS"]] + [["a"]] * 2
    passage = words(draw, 60)
    out += [[*words(draw, 30 + i), *passage, *words(draw, 20)] for i in range(12)]
    out.append(words(draw, 20_000) + passage)
    out += [["again"] * 200, ["again"] * 300 + ["end"]]
    pair = ["one", "two"] * 90
    out += [pair, ["zero", *pair], [*pair, *words(draw, 70), *pair[:80]], ["a", "b", "c"] * 40, ["c", "a", "b"] * 60]
    texts = [(i, "  ".join(w) + "\n") for i, w in enumerate(out)]
    return [*texts, (900, ""), (901, None), (902, " \n "), (None, texts[3][1]), (None, "alone " * 3), texts[5], (6, texts[41][1])]


def brute_classes(rows):
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for a, b in itertools.combinations(range(len(rows)), 2):
        shared = len(sets[a] & sets[b])
        if shared and shared >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[find(b)] = find(a)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    least = {r: min((i for i in members if i is not None), default=None) for r, members in ids.items()}
    classes = [(doc_id, least[find(i)], links[i]) for i, (doc_id, _) in enumerate(rows)]
    return classes, [find(i) for i in range(len(rows)) if sets[i]]


def test_classes_equal_brute_force(spark, rows):
    found = near_copies.classes(frame(spark, rows))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute_classes(rows)[0], key=repr)


def test_large_buckets_are_dealt_out_in_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK_TEXTS", 7)
    found = near_copies.classes(frame(spark, rows))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute_classes(rows)[0], key=repr)


def test_one_of_each_class_stays(spark, rows):
    docs = frame(spark, rows)
    kept = near_copies.one_of_each(docs)
    assert kept.schema == docs.schema
    classes, groups = brute_classes(rows)
    worded = {c for (_, c, _), (_, t) in zip(classes, rows, strict=True) if t and t.split() and c is not None}
    kept = kept.collect()
    blank = [r for r in kept if not (r.text or "").split()]
    assert sorted(r.doc_id for r in blank) == [900, 901, 902]
    named = [r.doc_id for r in kept if r not in blank]
    # one row for each class; two classes have 6 as their smallest id, and one has null ids only
    assert len(named) == len(set(groups)) and set(named) == worded | {None}
    assert sorted(i for i in named if i is not None) == sorted([*worded, 6])


def test_blank_rows_of_any_white_space_stay(spark):
    blanks = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]
    texts = [*blanks, "".join(blanks), "\u00a0", "", None, "\u200b", "\u200b", "\U0001f600", "\u00a0a"]
    docs = frame(spark, list(enumerate(texts)))
    again = texts.index("\u200b") + 1  # not white space, so a word, and this its copy
    assert sorted(r.doc_id for r in near_copies.one_of_each(docs).collect()) == [i for i in range(len(texts)) if i != again]


def test_empty_table(spark, rows):
    empty = frame(spark, rows).limit(0)
    assert near_copies.classes(empty).count() == near_copies.one_of_each(empty).count() == 0
    assert passages.repeats(empty).count() == passages.drop_repeats(empty).count() == 0


def test_bands_reach_the_recall():
    bands, size = near_copies.bands_for(0.8, 0.9995)
    assert 1 - (1 - 0.8**size) ** bands >= 0.9995 and bands * size <= 128


def test_shared_counts_equal_brute_force():
    draw = np.random.default_rng(1)
    for m in (2, 3, 20, 49, 90):
        base = draw.choice(5000, 80, False)
        sets = [
            np.unique(np.r_[base[draw.random(80) < 0.9], draw.choice(5000, draw.integers(0, 40))]).astype("u8")
            for _ in range(m)
        ]
        sets[1] = np.zeros(0, "u8")
        want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
        assert near_copies.shared_counts(sets).tolist() == want


def test_components(spark):
    draw = random.Random(3)
    chain = [(i, i + 1) for i in range(60)]
    rest = [(draw.randrange(100, 180), draw.randrange(100, 180)) for _ in range(50)]
    links = spark.createDataFrame(chain + rest + [(500, 500), (0, 1)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    near = defaultdict(set)
    for a, b in chain + rest:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for n in near[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        assert found[node] == min(seen)
    assert found.keys() == near.keys()


def brute_repeats(rows, length):
    seen = defaultdict(set)
    split = [(i, (t or "").lower().split()) for i, t in rows if i is not None]
    for i, w in split:
        for a in range(len(w) - length + 1):
            seen[tuple(w[a : a + length])].add(i)
    out = []
    for i, w in split:
        spans = {True: [], False: []}
        for a in range(len(w) - length + 1):
            ids = seen[tuple(w[a : a + length])]
            if len(ids) > 1:
                of = spans[min(ids) == i]
                if of and of[-1][1] >= a:
                    of[-1][1], of[-1][2] = a + length, min(of[-1][2], min(ids))
                else:
                    of.append([a, a + length, min(ids)])
        out += [(i, a, b - a, first, kept) for kept, of in spans.items() for a, b, first in of]
    return sorted(out)


@pytest.mark.parametrize("together", [10_000, 3])
def test_passages_equal_brute_force(spark, rows, together):
    found = passages.repeats(frame(spark, rows), passages.Settings(together=together))
    found = found.select("doc_id", "start", "n_words", "first_doc_id", "kept").collect()
    assert sorted(map(tuple, found)) == brute_repeats(rows, 50)


@pytest.mark.parametrize("together", [10_000, 1])
def test_unequal_windows_with_half_a_hash_in_common_are_no_repeat(spark, together):
    same = " ".join(f"same{i}" for i in range(49))
    texts = [f"{same} end{i}" for i in (78711, 125203)]
    high = [int(ngrams.runs(ngrams.Words().hashes(t), 50)[0]) >> 32 for t in texts]
    assert high[0] == high[1]
    docs = frame(spark, [*enumerate(texts), (2, texts[1])])
    found = passages.repeats(docs, passages.Settings(together=together)).collect()
    assert sorted((r.doc_id, r.n_words, r.first_doc_id) for r in found) == [(1, 50, 1), (2, 50, 1)]
    kept = {r.doc_id: r.text for r in passages.drop_repeats(docs, passages.Settings(together=together)).collect()}
    assert kept == {0: texts[0], 1: texts[1], 2: ""}


@pytest.mark.parametrize("together", [10_000, 1])
def test_texts_of_one_id_with_a_part_of_a_hash_in_common_are_cut_apart(spark, together):
    same = " ".join(f"same{i}" for i in range(60))
    docs = frame(spark, [(1, same), (7, f"{same} end945"), (7, "short7805"), (7, f"{same} end1923"), (7, "short2910")])
    low = docs.select(F.xxhash64("text").bitwiseAND(F.lit((1 << 24) - 1)).alias("low")).filter("low in (16211652, 16718397)")
    assert low.count() == 4
    kept = passages.drop_repeats(docs, passages.Settings(together=together)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, same), (7, "end1923"), (7, "end945"), (7, "short2910"), (7, "short7805")]


def test_repeats_are_taken_out(spark, rows):
    docs = frame(spark, rows)
    found = passages.drop_repeats(docs)
    assert found.schema == docs.schema
    found = found.collect()
    assert len(found) == len(rows)
    kept, cut = {}, defaultdict(set)
    for i, start, n, _, own in brute_repeats(rows, 50):
        if not own:
            cut[i] |= set(range(start, start + n))
    for r in found:
        kept.setdefault(r.doc_id, []).append(r)
        assert r.n_chars == (None if r.text is None else len(r.text))
    for doc_id, text in rows:
        if doc_id is None or doc_id in (5, 6):
            continue
        (row,) = kept[doc_id]
        if doc_id not in cut:
            assert row.text == text
        else:
            assert row.text.split() == [w for i, w in enumerate(text.split()) if i not in cut[doc_id]]
    assert passages.without("a b  c d\n e", [(1, 2)]) == "a d\n e"
    with pytest.raises(ValueError):
        passages.Settings(length=400)
