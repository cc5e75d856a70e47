"""The registered queries of the corpus operators: thin calls on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabflow.llm import convtrie, embdedup, langid, licenses, minhash, mixing, packing, pii, spelling, substrings, tokencount, topk, urlfilter
from cabflow.llm.common import table


def op1_topk(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return topk.top_k(e, e.where(F.col("vec_id") % 50 == 0), k=5)


def op2_language_id(spark, sf_dir):
    return langid.identify_corpus(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op3_license_scan(spark, sf_dir):
    return licenses.digest(licenses.scan_licenses(table(spark, sf_dir, "documents")))


def op4_pii(spark, sf_dir):
    return pii.digest(pii.find_spans(table(spark, sf_dir, "documents")))


def op5_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir):
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark, sf_dir):
    return embdedup.embedding_links(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark, sf_dir):
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


def op10_url_filter(spark, sf_dir):
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"))


def op11_spelling(spark, sf_dir):
    return spelling.variants(spelling.noised_words(table(spark, sf_dir, "documents")))


def op12_substrings(spark, sf_dir):
    return substrings.digest(substrings.remove_repeats(table(spark, sf_dir, "documents")))


def op13_conversation_trie(spark, sf_dir):
    return convtrie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_topk, op2_language_id, op3_license_scan, op4_pii, op5_packing, op6_minhash, op7_mixing, op8_embedding_dedup, op9_token_counts, op10_url_filter, op11_spelling, op12_substrings,
                                    op13_conversation_trie)}
ORACLE = {"op1_topk": topk.ORACLE, "op7_mixing": mixing.ORACLE, "op8_embedding_dedup": embdedup.ORACLE, "op11_spelling": spelling.ORACLE,
          "op12_substrings": substrings.ORACLE, "op13_conversation_trie": convtrie.ORACLE}
