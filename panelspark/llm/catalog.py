"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers

from panelspark.llm import (
    bpe, byte_cnn, chunks, language, mixing, pseudonyms, setjoin, spelling, topk, toxicity, warc, weak_rules, whitening)
from panelspark.session import read_table

QUERIES, ORACLES = {}, {}
#: The session's setting that holds the key of op7's pseudonyms.
PSEUDONYM_KEY = "panelspark.pseudonyms.key"


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return keep


@query("op4_exact_dedup", chunks.ORACLE)
def op4_exact_dedup(spark, sf_dir):
    """Copies of every document, by chunk recipes."""
    return chunks.exact_dedup(read_table(spark, sf_dir, "documents")).drop("row")


@query("op8_bpe")
def op8_bpe(spark, sf_dir):
    """Every document encoded and decoded with the 50k byte-level vocabulary."""
    return bpe.digests(read_table(spark, sf_dir, "documents"),
                       str(public_tokenizers.path("byte_bpe_50k.json")))


@query("op1_byte_cnn_quality")
def op1_byte_cnn_quality(spark, sf_dir):
    """Quality of every document by the byte-level network."""
    return byte_cnn.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op2_weak_rules", weak_rules.oracle())
def op2_weak_rules(spark, sf_dir):
    """Base checks and weakly supervised verdict of every document."""
    return weak_rules.weak_quality(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op3_language_fusion")
def op3_language_fusion(spark, sf_dir):
    """Language of every page from text, markup, suffix and host."""
    return language.page_language(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))


@query("op5_factorization_toxicity")
def op5_factorization_toxicity(spark, sf_dir):
    """Toxicity of every document by the factorization machine."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op6_cube_mixing")
def op6_cube_mixing(spark, sf_dir):
    """All documents mixed to their sources' target weights."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("row")


@query("op7_pseudonyms")
def op7_pseudonyms(spark, sf_dir):
    """Every document with pseudonyms for its personal numbers."""
    key = spark.conf.get(PSEUDONYM_KEY, "for the synthetic test tables only")
    return pseudonyms.pseudonymise(read_table(spark, sf_dir, "documents"), key)


@query("op9_warc", warc.ORACLE)
def op9_warc(spark, sf_dir):
    """Every page written to WARC archives and read back."""
    return warc.round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_ngram_jaccard", setjoin.ORACLE)
def op10_ngram_jaccard(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return setjoin.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op11_pivotal_grams")
def op11_pivotal_grams(spark, sf_dir):
    """Spelling variants among the words of all documents."""
    return spelling.variants(read_table(spark, sf_dir, "documents"))


@query("op12_qdwh_whitening")
def op12_qdwh_whitening(spark, sf_dir):
    """Every embedding whitened on its first components."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@query("op13_block_topk", topk.ORACLE)
def op13_block_topk(spark, sf_dir):
    """The five nearest of every fiftieth embedding among all."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))
