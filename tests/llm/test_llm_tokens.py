"""Byte-level BPE, token files and packing against the libraries themselves."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cardrail.llm import byte_bpe, packing, token_files
from cardrail.llm.queries import BYTE_RANKS, WORD_VOCABULARY
from cardrail.session import scratch_path

LONG = "lang " * 30_000 + "x" * 20_000
TEXTS = [
    "Hello world, it's fine. 123",
    "",
    None,
    "  \n\n x\t\r\n y  ",
    "İstanbul ΑΣ Ü é é \U0001f600 日本語 ﬁ ㎏",
    "a\x01b\x1c!\x1c! c d",
    "<|endoftext|> and <|startoftext|>",
    "a <|endoftext|> b, 日本<|startoftext|> <|ENDOFTEXT|>",
    "'ll don't '",
    "Hello world, it's fine. 123",
    LONG,
]
SCHEMA = "doc_id long, text string, ids string, n_tokens int, part int, piece string, place string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1, 2, "y", "z") for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", "x", 1, 2, "y", "z"), (3, "the id three again", "x", 1, 2, "y", "z")]
    rows += [rows[0]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def keyed(rows, *columns):
    return sorted(([r[c] for c in columns] for r in rows), key=repr)


def expected_byte_ids():
    import tiktoken

    with open(BYTE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own.encode_ordinary


def test_byte_bpe_equals_the_rank_library(docs):
    encode = expected_byte_ids()
    found = byte_bpe.encode_and_decode(docs, BYTE_RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    want = []
    for row in docs.collect():
        ids, raw = encode(row.text or ""), (row.text or "").encode()
        name = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append([row.doc_id, len(ids), name, hashlib.sha256(raw).hexdigest(), ids, bytearray(raw)])
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")
    assert keyed(found, *columns) == sorted(want, key=repr)


def test_byte_bpe_small_cache_gives_the_same():
    coder = byte_bpe.ByteBpe(BYTE_RANKS, public_tokenizers.PATTERN, remembered=1)
    encode = expected_byte_ids()
    texts = [t or "" for t in TEXTS]
    assert list(coder.encode(texts)) == [encode(t) for t in texts]


def test_byte_bpe_empty_table(docs):
    assert byte_bpe.encode_and_decode(docs.limit(0), BYTE_RANKS, public_tokenizers.PATTERN).count() == 0


def word_ids(text):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_VOCABULARY)
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, docs):
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, path, WORD_VOCABULARY, end_id=1)
    stored = token_files.read_token_files(spark, path)
    ids = {(r.doc_id, r.text): [*word_ids(r.text), 1] for r in docs.collect()}
    assert sorted(map(list, (r.ids for r in stored.collect()))) == sorted(
        [ids[r.doc_id, r.text] for r in docs.collect()]
    )
    found = sorted(token_files.documents_in(stored).collect(), key=lambda r: r.start)
    start = 0
    for row in found:
        assert row.start == start
        start += row.n_tokens
    assert [r.doc_id for r in found] == sorted((r.doc_id for r in found), key=lambda i: -1 if i is None else i)
    want = sorted(([i, len(v), crc(v)] for (i, _), v in ids.items()), key=repr)
    assert [w for w in want if w[0] not in (0,)] == [k for k in keyed(found, "doc_id", "n_tokens", "ids_crc32") if k[0] != 0]
    assert sum(r.doc_id == 0 for r in found) == 2


def test_token_files_are_pruned_by_id(spark, docs, tmp_path):
    from pyarrow import orc

    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, path, WORD_VOCABULARY, end_id=1)
    plan = token_files.read_token_files(spark, path).filter("doc_id = 4")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,4)" in plan
    import glob

    files = glob.glob(f"{path.removeprefix('file:')}/*.orc")
    assert files and all(orc.ORCFile(f).compression.upper() == "ZSTD" for f in files)


def test_token_files_empty_table(spark, docs):
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs.limit(0), path, WORD_VOCABULARY, end_id=1)
    assert token_files.documents_in(token_files.read_token_files(spark, path)).count() == 0


def sequences(rows):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    return held


def test_packing(docs):
    found = packing.pack_documents(docs, WORD_VOCABULARY, end_id=0).collect()
    want = []
    for row in docs.collect():
        ids = [*word_ids(row.text), 0]
        for piece, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            want.append([row.doc_id, piece, a, len(part), crc(part)])
    assert keyed(found, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want, key=repr)
    for pieces in sequences(found).values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048
    assert packing.pack_documents(docs.limit(0), WORD_VOCABULARY, end_id=0).count() == 0


def test_packing_in_small_groups_keeps_every_piece(docs):
    many = docs.filter("length(text) < 1000").crossJoin(docs.sparkSession.range(40).select(F.col("id").alias("copy")))
    found = packing.pack_documents(many, WORD_VOCABULARY, end_id=0, group_pieces=16).collect()
    assert len(found) == many.count()
    assert all(sum(n for _, n in p) <= 2048 for p in sequences(found).values())


@pytest.mark.parametrize("fit", ["norm", "dot"])
def test_bins_hold_every_capacity(fit):
    draw = np.random.default_rng(1)
    lengths = draw.integers(1, 700, 600).tolist()
    limits = packing.Capacities(tokens=1000, pieces=4, attention=500_000, fit=fit)
    bins, offsets = packing.pack(lengths, limits)
    held = defaultdict(list)
    for length, number, offset in zip(lengths, bins, offsets, strict=True):
        held[number].append((offset, length))
    for pieces in held.values():
        sizes = [n for _, n in sorted(pieces)]
        assert [o for o, _ in sorted(pieces)] == [sum(sizes[:i]) for i in range(len(sizes))]
        assert sum(sizes) <= 1000 and len(sizes) <= 4 and sum(n * n for n in sizes) <= 500_000


def test_packing_is_best_fit():
    # brute force: the same rule over every open bin
    draw = np.random.default_rng(2)
    lengths = draw.integers(1, 2049, 400).tolist()
    limits = packing.Capacities()
    rests, want = [], [0] * len(lengths)
    whole = (limits.tokens, limits.pieces, limits.attention)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        takes = (lengths[i], 1, lengths[i] ** 2)
        fits = [b for b, r in enumerate(rests) if all(x >= t for x, t in zip(r, takes, strict=True))]
        cost = {b: sum(w * ((r - t) / c) ** 2 for w, r, t, c in zip(limits.weights, rests[b], takes, whole, strict=True)) for b in fits}
        if not fits:
            rests.append(whole)
            cost = {len(rests) - 1: 0}
        b = min(cost, key=lambda b: (round(cost[b], 12), b))
        rests[b] = tuple(r - t for r, t in zip(rests[b], takes, strict=True))
        want[i] = b
    found, _ = packing.pack(lengths, limits)
    assert len(set(found)) == len(rests) == len(set(want))
    assert len(rests) <= 1.05 * max(sum(lengths) / 2048, sum(n > 1024 for n in lengths)) + 1
    with pytest.raises(ValueError):
        packing.pack([2049], limits)
