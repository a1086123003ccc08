"""Registered queries of this package, and the check queries of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardrail.llm import (
    alignment,
    byte_bpe,
    cover_tree,
    hnsw,
    lexicon,
    main_text,
    near_copies,
    packing,
    passages,
    phrases,
    quality,
    token_files,
    warc,
)
from cardrail.llm.common import table
from cardrail.session import scratch_path

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest other vectors found for every vector whose id 100 divides."""
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), divisor=100, k=10)


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of 50 words or more, in every document, that another document has too."""
    found = passages.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "n_words", "first_doc_id", "kept")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near copies, and with how many it is linked directly."""
    return near_copies.classes(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded to byte-level BPE ids and decoded again."""
    return byte_bpe.encode_and_decode(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    pages = table(spark, sf_dir, "pages")
    return main_text.extract(pages, main_text.learn(pages))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's quality score, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    return found.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids written to ORC files in order of ``doc_id`` and read back."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, WORD_VOCABULARY, end_id=1)
    return token_files.documents_in(token_files.read_token_files(spark, path))


def op8_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 greatest inner products, in units of 1/256, for every vector whose id 50 divides."""
    return cover_tree.greatest(table(spark, sf_dir, "embeddings"), divisor=50, k=5, scale=256)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's pieces packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY, end_id=0)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back. Blocks above 16 KiB are split into segments."""
    pages = table(spark, sf_dir, "pages")
    found = warc.archive_round_trip(pages, scratch_path(spark, "warc"), segment_bytes=16 << 10)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of two to five words of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded to byte-level BPE ids through a lexicon of frequent words, and decoded again."""
    return lexicon.encode_and_decode(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's tokens by two vocabularies, aligned where both end, with how often linked ids meet."""
    return alignment.align(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)


OPERATORS = (
    op1_hnsw,
    op2_passages,
    op3_ngram_join,
    op4_byte_bpe,
    op5_main_text,
    op6_quality,
    op7_token_files,
    op8_top_products,
    op9_packing,
    op10_warc,
    op11_phrases,
    op12_lexicon,
    op13_alignment,
)

QUERIES = {f.__name__: f for f in OPERATORS}

ORACLE_SQL: dict[str, str] = {}
