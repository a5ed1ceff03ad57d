"""Registered queries of the operators, with production parameters, over the
whole of their tables; each derives the contract's columns from the operator's
own output."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.llm import (
    collocations, crf_extract, decontaminate, hilbert_shards, license_digest, mixing, quality_rules, rans,
    redirect_filter, simhash_vptree, spelling_variants, toxic_segments, warc,
)
from mercato.llm.common import read_table


def op1_rans_token_blocks(spark, sf_dir):
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents")
    return rans.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op2_warc(spark, sf_dir):
    return warc.round_trip(read_table(spark, sf_dir, "pages"), with_payload=False).drop("payload")


def op3_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op4_toxic_segments(spark, sf_dir):
    found = toxic_segments.detect(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "n_segments")


def op5_decontaminate(spark, sf_dir):
    return decontaminate.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_simhash_vptree(spark, sf_dir):
    found = simhash_vptree.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op7_quality_rules(spark, sf_dir):
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op8_crf_extract(spark, sf_dir):
    return crf_extract.extract(read_table(spark, sf_dir, "pages"))


def op9_license_digest(spark, sf_dir):
    return license_digest.scan(read_table(spark, sf_dir, "documents"))


def op10_hilbert_shards(spark, sf_dir):
    found = hilbert_shards.write_shards(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "cell")


def op11_redirect_filter(spark, sf_dir):
    return redirect_filter.judge(read_table(spark, sf_dir, "pages"))


def op12_reduced_alphabet(spark, sf_dir):
    return spelling_variants.variants(read_table(spark, sf_dir, "documents"))


def op13_multikey_quicksort(spark, sf_dir):
    return collocations.mine(read_table(spark, sf_dir, "documents"))


def llm_queries():
    return {name: f for name, f in globals().items() if name.startswith("op")}


def llm_oracle_sql():
    return {"op3_mixing": mixing.oracle_sql(),
            "op9_license_digest": license_digest.ORACLE_SQL,
            "op11_redirect_filter": redirect_filter.ORACLE_SQL,
            "op13_multikey_quicksort": collocations.ORACLE_SQL}
