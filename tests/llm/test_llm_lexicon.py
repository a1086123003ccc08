"""The lexicon encoder and the alignment against the libraries themselves and brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

from cardrail.llm import alignment, lexicon
from cardrail.llm.queries import BYTE_VOCABULARY, PIECE_MODEL

PARTS = ["a", "b", " ", "  ", "\n", "'s", "é", "ß", "日", "\xa0", "\x1c", "\x85", "😀", "<|endoftext|>", "<s>", "<0x41>", "1", "²"]
PARTS += ["-", "　", "\r", "\t", "Ⅷ", "\x00", "\x01", "hello", "the ", " the", "▁", ".", "!!\x1d", ";"]
LONG = "lang " * 20_000 + "x" * 20_000


def texts():
    draw = random.Random(5)
    made = ["".join(draw.choices(PARTS, k=draw.randint(1, 30))) for _ in range(400)]
    return [*made, "", None, " ", "  ", "\n", " \n ", "one  two ", "<|endoftext|>", "one  two ", LONG]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "x", "y") for i, t in enumerate(texts())] + [(None, "no id", 1, "x", "y"), (3, "the id three", 1, "x", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids int, pairs string, n string").repartition(3)


@cache
def byte_library(plain=False):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_VOCABULARY)
    library.encode_special_tokens = plain
    return library


def by_key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("words", [0, 40, 1 << 17])
def test_lexicon_equals_the_library(docs, words):
    library, want = byte_library(), []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), text.encode())]
        want.append([r.doc_id, len(ids), *digests, ids, text])
    found = lexicon.encode_and_decode(docs, BYTE_VOCABULARY, lexicon.Settings(words=words), with_ids=True)
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")
    assert by_key([r[c] for c in columns] for r in found.collect()) == by_key(want)


def test_lexicon_empty_table(docs):
    assert lexicon.encode_and_decode(docs.limit(0), BYTE_VOCABULARY).count() == 0


def test_frequent_words_are_the_most_frequent(spark, docs):
    vocabulary = lexicon.Vocabulary(BYTE_VOCABULARY)
    counts = Counter(w for t in texts() for w in vocabulary.words(t or ""))
    counts += Counter(w for t in ("no id", "the id three") for w in vocabulary.words(t))
    found = lexicon.frequent_words(docs, BYTE_VOCABULARY, lexicon.Settings(words=30))
    assert 0 < len(found) <= 30
    assert min(counts[w] for w in found) > max(n for w, n in counts.items() if w not in found and len(w.encode()) <= 64)


def test_automaton_is_minimal_and_numbers_its_words():
    draw = random.Random(3)
    words = sorted({bytes(draw.choices(b"ab\xff", k=draw.randint(0, 6))) for _ in range(300)})
    automaton = lexicon.Automaton(words)
    # as many states as there are different sets of endings
    endings = defaultdict(set)
    for w in words:
        for k in range(len(w) + 1):
            endings[w[:k]].add(w[k:])
    assert len(automaton.arcs) == len({frozenset(x) for x in endings.values()})
    assert len(automaton.arcs) < len(endings)


def test_lexicon_file_accepts_its_words_only(tmp_path):
    words = [" the", " then", "the", "a", "日本", "x" * 60]
    file = tmp_path / "lexicon.bin"
    file.write_bytes(lexicon.compile_lexicon(words, lexicon.Vocabulary(BYTE_VOCABULARY)))
    held = lexicon.Lexicon(str(file))
    assert isinstance(held.keys.base, np.memmap) or isinstance(held.keys, np.memmap)
    ordered = sorted(w.encode() for w in words)
    assert [ordered[i] for i in held.numbers([w.encode() for w in words])] == [w.encode() for w in words]
    assert (held.numbers([b"", b" th", b"thenn", b"\xff", "日".encode()]) == -1).all()


def token_bytes(piece):
    of_byte = re.fullmatch("<0x(..)>", piece)
    return bytes([int(of_byte[1], 16)]) if of_byte else piece.replace("▁", " ").encode()


@cache
def piece_library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


@cache
def byte_names():
    return lexicon.Vocabulary(BYTE_VOCABULARY).bytes_of


def aligned_by_force(text):
    """Ids of both, the groups' text, and the links, from the libraries and the sets of token ends."""
    nothing = [], [], "", []
    if not text:
        return nothing
    library, model = byte_library(plain=True), piece_library()
    a, b = library.encode(f" {text}", add_special_tokens=False).ids, model.encode(text)
    spelled = [[byte_names()[i] for i in a], [token_bytes(model.id_to_piece(i)) for i in b]]
    if any(b"".join(x) != f" {text}".encode() for x in spelled):
        return nothing
    ends = [np.cumsum(list(map(len, x))).tolist() for x in spelled]
    groups, links, p, q = [], [], 0, 0
    for end in sorted({*ends[0]} & {*ends[1]}):
        i, j = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append(f"{','.join(map(str, a[p:i]))}|{','.join(map(str, b[q:j]))}")
        links.append((a[i - 1], b[j - 1]))
        p, q = i, j
    return a, b, ";".join(groups), links


def test_alignment_equals_brute_force(docs):
    short = docs.filter("length(text) < 10000 or text is null")
    rows = [(r.doc_id, *aligned_by_force(r.text)) for r in short.collect()]
    counts = Counter(link for row in rows for link in row[-1])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    want = [
        [
            doc_id,
            len(a),
            len(b),
            text.count("|"),
            len(links),
            sum(counts[x] == best[x[1]] for x in links),
            sum(counts[x] for x in links),
            text and hashlib.sha256(text.encode()).hexdigest(),
        ]
        for doc_id, a, b, text, links in rows
    ]
    assert by_key(map(list, alignment.align(short, BYTE_VOCABULARY, PIECE_MODEL, block_chars=500).collect())) == by_key(want)


def test_alignment_of_a_long_text_and_of_none(docs):
    found = {r.doc_id: r for r in alignment.align(docs.filter("length(text) > 10000"), BYTE_VOCABULARY, PIECE_MODEL).collect()}
    (row,) = found.values()
    assert row.n_a > 20_000 and row.n_links == row.n_groups > 20_000
    assert alignment.align(docs.limit(0), BYTE_VOCABULARY, PIECE_MODEL).count() == 0
    empty = alignment.align(docs.filter("text is null"), BYTE_VOCABULARY, PIECE_MODEL).collect()
    assert [list(r)[1:] for r in empty] == [[0] * 6 + [""]]


def test_diagonal_runs_find_every_common_end():
    draw = random.Random(7)
    for _ in range(300):
        size = draw.randint(1, 60)
        a, b = (sorted({*draw.sample(range(1, size + 1), draw.randint(1, size)), size}) for _ in "ab")
        runs = alignment.diagonal_runs(a, b)
        ends = [(i + k, j + k) for i, j, n in runs for k in range(n)]
        assert [a[i] for i, _ in ends] == [b[j] for _, j in ends] == sorted({*a} & {*b})
        # all groups of a run but its first are one token against one
        assert sum(n for _, _, n in runs) == len(ends) and len(runs) <= len(ends)
