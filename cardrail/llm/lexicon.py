"""Byte-level BPE through a lexicon: a minimal acyclic transducer from frequent words to their ids.

1. All pre-tokens of all texts are counted. The most frequent are the lexicon's words, at most ``Settings.words``.
2. They are compiled, in the order of their bytes, into a minimal acyclic automaton: words share prefixes, and equal
   suffixes are one state. A transition puts out how many words come before those it leads to, so that the outputs on a
   word's path add up to its place in that order, where its ids stand. The automaton is flat arrays in one file,
   which Spark hands to the executors and each worker maps into memory.
3. The different pre-tokens of some texts walk through the automaton together, byte by byte. Those that it doesn't
   accept are merged exactly, by the vocabulary's own merges. What is in the lexicon changes no id.

An added token of the vocabulary (``<|endoftext|>``) that stands in a text is that token, as the library has it. Texts
in Latin-1 are split by the byte-level pattern, any others by the library's splitter.

Defined results: a null text counts as empty and has no ids; rows come out as often as they come in, also with a null
or repeated ``doc_id``; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardrail.llm.byte_bpe import byte_characters
from cardrail.llm.common import held_in_worker, slices, small, written
from cardrail.llm.segments import Rows, cut, is_latin, latin_findall, numbered
from cardrail.session import scratch_path

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: Fixed value: how byte-level BPE splits texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters encoded together, and different words that a task counts before it hands them on.
RUN_CHARS, COUNTED = 4_000_000, 400_000


@dataclass(frozen=True)
class Settings:
    #: The most words in the lexicon, and the most bytes of one: the file stays below some 30 MB.
    words: int = 1 << 17
    word_bytes: int = 64
    #: A word seen less often is not frequent.
    least: int = 2


class Vocabulary:
    """Splits texts and merges words by a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        with open(path, "rb") as file:
            rules = json.load(file)
        splitter = rules["pre_tokenizer"]
        if rules["normalizer"] or splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or not splitter["use_regex"]:
            raise ValueError(f"{path}: another normaliser or splitter than this class is for")
        self.model, self.splitter = library.model, library.pre_tokenizer
        self.latin = latin_findall(PATTERN)
        self.to_characters = dict(enumerate(byte_characters()))
        back = {c: b for b, c in self.to_characters.items()}
        # an added token's characters stand for themselves where no byte has them
        added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        for token in rules["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"] or len(self.latin(token["content"])) < 2:
                raise ValueError(f"{path}: the added token {token['content']} is of a kind that this class is not for")
        self.added = added
        longest_first = sorted(added, key=len, reverse=True)
        self.at_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if added else None
        self.bytes_of = [b""] * (1 + max([*rules["model"]["vocab"].values(), *added.values()]))
        for token, i in [*rules["model"]["vocab"].items(), *added.items()]:
            self.bytes_of[i] = b"".join(bytes([back[c]]) if c in back else c.encode() for c in token)

    def words(self, text: str, added: bool = True) -> list[str]:
        """The pre-tokens of a text in their order; with ``added``, an added token is one of its own."""
        if added and self.at_added and any(t in text for t in self.added):
            parts = self.at_added.split(text)
            return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self.words(part, False))]
        if is_latin(text):
            return self.latin(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def merged(self, word: str) -> list[int]:
        if word in self.added:
            return [self.added[word]]
        return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.to_characters))]


def frequent_words(docs: DataFrame, vocabulary: str, s: Settings) -> list[str]:
    """The most frequent pre-tokens of all texts, at most ``s.words``.

    All are counted, by partial counts in the tasks. A threshold from a histogram of the counts (some hundred rows) keeps
    what comes to the driver below that number.
    """

    def run(batches):
        import pyarrow as pa

        coder, counts = held_in_worker(vocabulary, lambda: Vocabulary(vocabulary)), Counter()

        def told():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in small(batches):
            for text in batch.column("text").to_pylist():
                counts.update(coder.words(text or ""))
                if len(counts) > COUNTED:
                    yield told()
                    counts.clear()
        yield told()

    counts = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = counts.filter((F.col("n") >= s.least) & (F.octet_length("word") <= s.word_bytes))
    size = F.floor(16 * F.log2("n")).cast("int").alias("size")
    counts = written(counts.select("word", size), "words")
    room, least = s.words, None
    for step in counts.groupBy("size").count().orderBy(F.desc("size")).collect():
        room -= step["count"]
        if room < 0:
            break
        least = step["size"]
    return [] if least is None else [r.word for r in counts.filter(F.col("size") >= least).select("word").collect()]


class Automaton:
    """A minimal acyclic automaton of byte strings that come in order; a state is a number, 0 the start."""

    def __init__(self, words: Iterable[bytes]):
        self.known: dict[tuple, int] = {}
        self.arcs: list[tuple[tuple[int, int], ...]] = []
        self.final: list[bool] = []
        # states on the path of the last word: is it an end, and its arcs so far
        path: list[list] = [[False, []]]
        last = b""
        for word in words:
            same = len(os.path.commonprefix([last, word]))
            self._close(path, last, same)
            path += [[False, []] for _ in word[same:]]
            path[-1][0] = True
            last = word
        self._close(path, last, 0)
        self.start = self._state(path[0])

    def _close(self, path: list[list], word: bytes, keep: int) -> None:
        while len(path) > keep + 1:
            state = self._state(path.pop())
            path[-1][1].append((word[len(path) - 1], state))

    def _state(self, found: list) -> int:
        key = (found[0], tuple(found[1]))
        if key not in self.known:
            self.known[key] = len(self.arcs)
            self.final.append(found[0])
            self.arcs.append(key[1])
        return self.known[key]

    def arrays(self) -> dict[str, np.ndarray]:
        """``keys`` (state * 256 + byte, ascending), and of each the state it leads to and the words it passes over."""
        below: list[int] = []  # a state's arcs lead to states that were closed before
        keys, target, skip = [], [], []
        for state, arcs in enumerate(self.arcs):
            n = int(self.final[state])
            for byte, to in arcs:
                keys.append(state << 8 | byte)
                target.append(to)
                skip.append(n)
                n += below[to]
            below.append(n)
        return {"keys": np.array(keys, "i8"), "target": np.array(target, "i8"), "skip": np.array(skip, "i8"), "final": np.array(self.final, "i8")}


def compile_lexicon(words: list[str], vocabulary: Vocabulary) -> bytes:
    """The file: how many numbers each part has and where the automaton starts, then the parts, all 64-bit."""
    coded = sorted((w.encode(), w) for w in words)
    automaton = Automaton(raw for raw, _ in coded)
    ids = Rows.of([vocabulary.merged(w) for _, w in coded])
    parts = [*automaton.arrays().values(), np.r_[0, np.cumsum(ids.lengths)].astype("i8"), ids.values]
    return b"".join(p.astype("<i8").tobytes() for p in (np.array([automaton.start, *map(len, parts)]), *parts))


class Lexicon:
    def __init__(self, path: str):
        flat = np.memmap(path, "<i8", "r")
        self.start, sizes = int(flat[0]), flat[1:7]
        self.keys, self.target, self.skip, self.final, self.ends, self.ids = np.split(flat[7:], np.cumsum(sizes)[:-1])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the lexicon, or -1. All walk together, a byte a step."""
        out = np.full(len(words), -1)
        size = np.fromiter(map(len, words), "i8", len(words))
        if not len(self.keys):
            return out
        raw, at = np.frombuffer(b"".join(words), "u1"), np.cumsum(size) - size
        walking = np.argsort(-size, kind="stable")
        state, place = np.full(len(words), self.start), np.zeros(len(words), "i8")
        step, longest_first = 0, size[walking]
        while len(walking):
            n = int(np.searchsorted(-longest_first, -step, "left"))  # the others have ended
            done = walking[n:]
            done = done[self.final[state[done]] == 1]
            out[done] = place[done]
            walking = walking[:n]
            key = state[walking] << 8 | raw[at[walking] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[arc] == key
            walking, arc, longest_first = walking[there], arc[there], longest_first[:n][there]
            place[walking] += self.skip[arc]
            state[walking] = self.target[arc]
            step += 1
        return out

    def rows(self) -> Rows:
        return Rows(self.ids, np.diff(self.ends))


class Coder:
    def __init__(self, vocabulary: str, lexicon: str):
        self.vocabulary, self.lexicon = Vocabulary(vocabulary), Lexicon(lexicon)
        self.rows = self.lexicon.rows()

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for run in slices([t or "" for t in texts], RUN_CHARS):
            words, codes, ends = numbered([self.vocabulary.words(t) for t in run])
            place = self.lexicon.numbers([w.encode() for w in words])
            unseen = np.flatnonzero(place < 0)
            merged = Rows.of([self.vocabulary.merged(words[i]) for i in unseen])
            known = self.rows.take(place[place >= 0])
            # rows of known words first, then of unseen ones
            row = np.empty(len(words), "i8")
            row[place >= 0] = np.arange(len(known.lengths))
            row[unseen] = len(known.lengths) + np.arange(len(unseen))
            both = Rows(np.concatenate([known.values, merged.values]), np.concatenate([known.lengths, merged.lengths]))
            found = both.take(row[codes])
            until = np.r_[0, np.cumsum(found.lengths)][ends]
            yield from cut(found.values, until)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def hand_out(spark: SparkSession, content: bytes) -> str:
    """Gives every executor a file, and returns the name to ask ``SparkFiles`` for."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{scratch_path(spark, 'files')}/{name}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(jvm_path)
    for a in range(0, len(content), 1 << 20):
        stream.write(bytearray(content[a : a + (1 << 20)]))
    stream.close()
    spark.sparkContext.addFile(path)
    return name


def encode_and_decode(docs: DataFrame, vocabulary: str, s: Settings | None = None, with_ids: bool = False) -> DataFrame:
    """Per document the number of ids, and the digests of the ids and of the text they decode to.

    ``with_ids`` adds the ids and the decoded text themselves. Counting words shuffles partial counts of words; encoding
    is one narrow pass.
    """
    spark = docs.sparkSession
    words = frequent_words(docs, vocabulary, s or Settings())
    name = hand_out(spark, compile_lexicon(words, Vocabulary(vocabulary)))
    schema = SCHEMA + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches):
        import pyarrow as pa
        from pyspark import SparkFiles

        coder = held_in_worker((vocabulary, name), lambda: Coder(vocabulary, SparkFiles.get(name)))
        for batch in small(batches):
            rows = []
            for ids in coder.encode(batch.column("text").to_pylist()):
                text = coder.decode(ids.tolist())
                rows.append((len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids, text))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()][: 3 + 2 * with_ids]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=False)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names[: 1 + len(arrays)])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)
