"""Byte-level BPE with ranks, run by a sentencepiece model that is serialised from the rank file.

A rank file lists byte strings by merge rank. Each becomes a piece: every byte is mapped to one printable character,
the score is the negative rank, the model type is BPE and the normaliser is the identity (no prefix, no space
handling). The merge that sentencepiece prefers, highest score and then leftmost, is then the merge of lowest rank.
Texts are split by the pattern first, the pre-tokens are encoded, and ids are decoded by the inverse of the byte map.

Defined results: a null text counts as empty and has no ids; rows come out as often as they come in, also with a null
or repeated ``doc_id``; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.sql import DataFrame

from cardrail.llm.common import held_in_worker, slices, small

REMEMBERED_TOKENS = 300_000

#: Stands between pre-tokens that are encoded in one call. No byte is mapped to it and no piece holds it, so it is
#: unknown text to the model and nothing merges across it.
MARK = "\x01"

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else one from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, in the order of their ranks."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranked[i] for i in range(len(ranked))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece model (its protobuf message) with a piece for each token, and one for unknown text."""
    characters = byte_characters()

    def piece(text: str, score: float, kind: int) -> bytes:
        return _bytes(1, _bytes(1, text.encode()) + b"\x15" + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece("".join(map(characters.__getitem__, t)), -rank, 1) for rank, t in enumerate(tokens)]
    pieces.append(piece("<unk>", 0, 2))
    no_id = 2**64 - 1  # -1
    trainer = _number(3, 2) + _number(4, len(pieces)) + _number(40, len(tokens))
    trainer += b"".join(_number(field, no_id) for field in (41, 42, 43))
    normalizer = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normalizer)


class ByteBpe:
    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED_TOKENS):
        import regex
        import sentencepiece

        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        self.unknown = len(self.tokens)
        self.split = regex.compile(pattern).findall
        self.to_characters = dict(enumerate(byte_characters()))
        from_character = {c: b for b, c in self.to_characters.items()}
        pieces = map(self.model.id_to_piece, range(len(self.tokens)))
        self.bytes_of = [bytes(from_character[c] for c in piece) for piece in pieces]
        self.remembered = remembered
        self.known: dict[str, list[int]] = {}

    def _learn(self, pre_tokens: set[str]) -> None:
        if len(self.known) > self.remembered:
            self.known = {}
        new = [t for t in pre_tokens if t not in self.known]
        for i in range(0, len(new), 1000):
            run = new[i : i + 1000]
            mapped = [t.encode().decode("latin-1").translate(self.to_characters) for t in run]
            ids, end = self.model.encode(MARK.join([*mapped, ""])), -1
            for t in run:
                start, end = end + 1, ids.index(self.unknown, end + 1)
                self.known[t] = ids[start:end]

    def encode(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        for run in slices([t or "" for t in texts]):
            pre_tokens = list(map(self.split, run))
            self._learn(set().union(*pre_tokens))
            known = self.known.__getitem__
            for tokens in pre_tokens:
                yield list(chain.from_iterable(map(known, tokens)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The encoder of a rank file, loaded once in each Python worker."""
    return held_in_worker((path, pattern), lambda: ByteBpe(path, pattern))


def encode_and_decode(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Per document the number of ids, and the digests of the ids and of the bytes they decode to.

    ``with_ids`` adds the ids and the decoded bytes themselves. One narrow pass: no shuffle, and a task holds one
    batch of texts.
    """
    schema = SCHEMA + (", ids array<int>, decoded binary" if with_ids else "")

    def run(batches):
        import pyarrow as pa

        coder = byte_bpe(path, pattern)
        names = list(map(str, range(len(coder.tokens))))
        for batch in small(batches):
            digests, extra = [], []
            for ids in coder.encode(batch.column("text").to_pylist()):
                decoded = coder.decode(ids)
                text = " ".join(map(names.__getitem__, ids))
                digests.append((len(ids), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                if with_ids:
                    extra.append((ids, decoded))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.binary()]
            columns = [*(zip(*digests) if digests else ((), (), ())), *(zip(*extra) if extra else ((), ()) * with_ids)]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: 1 + len(arrays)],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)
