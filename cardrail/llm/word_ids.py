"""Token ids of whole texts by a vocabulary file of the tokenizers library."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

from cardrail.llm.byte_bpe import byte_characters
from cardrail.llm.common import held_in_worker, slices

#: Pieces of texts that a worker remembers; they stay below some 100 MB.
REMEMBERED = 500_000


def latin_splitter(pattern: str) -> Callable[[str], list[str]]:
    """The vocabulary's pattern for lowered Latin-1 texts: its classes, which stand inside brackets, are spelled out."""
    latin = [chr(i) for i in range(256)]
    kinds = {rf"\p{{{k}}}": [c for c in latin if unicodedata.category(c)[0] == k] for k in "LN"}
    # white space as the library sees it, which leaves out the separators U+001C to U+001F
    kinds[r"\s"] = [c for c in latin if c.isspace() and not "\x1c" <= c <= "\x1f"]
    for name, characters in kinds.items():
        pattern = pattern.replace(name, "".join(map(re.escape, characters)))
    return re.compile(pattern).findall


class WordIds:
    """Encodes texts; ids come as little-endian unsigned 32-bit integers.

    For a file that puts texts into NFC and lower case, splits them by a pattern and drops white space. A text in Latin-1
    is in NFC already; it is lowered and split here, and the library's model encodes each of its pieces. Of any other
    text, no token crosses a blank or a line break, and each chunk in between goes through the whole library. Pieces and
    chunks are encoded once and then looked up. A text that holds an added token, in any case, goes through the library
    as a whole, which makes it that token's id.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        with open(path, "rb") as file:
            rules = json.load(file)
        kinds = [x["type"] for x in rules["normalizer"]["normalizers"]]
        split, as_bytes = rules["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or as_bytes["use_regex"]:
            raise ValueError(f"{path}: another normaliser or splitter than this class is for")
        self.added = [t["content"].lower() for t in rules["added_tokens"]]
        self.split = latin_splitter(split["pattern"]["Regex"])
        self.to_characters = dict(enumerate(byte_characters()))
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self.to_characters)
        return b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped))

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.library.encode(chunk, add_special_tokens=False).ids)

    def _look_up(self, known: dict[str, bytes], lists: list[list[str]], make: Callable[[str], bytes]) -> Iterator[bytes]:
        if len(known) > REMEMBERED:
            known.clear()
        for text in set().union(*lists).difference(known):
            known[text] = make(text)
        for texts in lists:
            yield b"".join(map(known.__getitem__, texts))

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """One byte string of ids for each text; null counts as empty."""
        for run in slices([t or "" for t in texts]):
            kinds = list(map(self._kind, run))
            by_kind = {k: [t for t, kind in zip(run, kinds, strict=True) if kind == k] for k in ("latin", "other", "added")}
            pieces = [self.split(t.lower()) for t in by_kind["latin"]]
            chunks = [t.replace("\n", " ").split(" ") for t in by_kind["other"]]
            found = {
                "latin": self._look_up(self.pieces, pieces, self._piece),
                "other": self._look_up(self.chunks, chunks, self._chunk),
                "added": map(self._chunk, by_kind["added"]),
            }
            for kind in kinds:
                yield next(found[kind])

    def _kind(self, text: str) -> str:
        lowered = text.lower()
        if any(t in lowered for t in self.added):
            return "added"
        return "latin" if _is_latin(text) else "other"


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def word_ids(path: str) -> WordIds:
    """The encoder of a vocabulary file, loaded once in each Python worker."""
    return held_in_worker(path, lambda: WordIds(path))
