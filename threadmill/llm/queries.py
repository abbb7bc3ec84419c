"""The registered query of each operator, over its whole table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadmill.llm import sql
from threadmill.llm.common import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(oracle: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return deco


@_query(sql.SUBSTRING_DEDUP)
def op1_substring_dedup(spark, sf_dir):
    from threadmill.llm.substring_dedup import substring_dedup
    return substring_dedup(scan(spark, sf_dir, "documents")).drop("kept_text")


@_query()
def op2_lm_scoring(spark, sf_dir):
    from threadmill.llm.lm_score import lm_score
    return lm_score(scan(spark, sf_dir, "documents"))


@_query(sql.TOP_K)
def op3_exact_top_k(spark, sf_dir):
    from threadmill.llm.top_k import exact_top_k
    return exact_top_k(scan(spark, sf_dir, "embeddings"))


@_query()
def op4_quality(spark, sf_dir):
    from threadmill.llm.quality import score_quality
    return score_quality(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "labels"))


@_query(sql.MIXING)
def op5_mixing(spark, sf_dir):
    from threadmill.llm.mixing import mix
    return mix(scan(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@_query()
def op6_packing(spark, sf_dir):
    from threadmill.llm.packing import pack
    return pack(scan(spark, sf_dir, "documents"))


@_query()
def op7_toxicity(spark, sf_dir):
    from threadmill.llm.toxicity import score_toxicity
    return score_toxicity(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "labels"))


@_query()
def op8_html_text(spark, sf_dir):
    from threadmill.llm.html_text import extract_main_text
    return extract_main_text(scan(spark, sf_dir, "pages"))


@_query(sql.MINHASH_DEDUP)
def op9_minhash_dedup(spark, sf_dir):
    from threadmill.llm.minhash_dedup import minhash_dedup
    return minhash_dedup(scan(spark, sf_dir, "documents")).drop("version", "group")


@_query(sql.EXACT_DEDUP)
def op10_exact_dedup(spark, sf_dir):
    from threadmill.llm.exact_dedup import exact_dedup
    return exact_dedup(scan(spark, sf_dir, "documents")).drop("code_points", "version")


@_query(sql.COLLOCATIONS)
def op11_collocations(spark, sf_dir):
    from threadmill.llm.collocations import mine_collocations
    return mine_collocations(scan(spark, sf_dir, "documents"))


@_query(sql.SPELLING)
def op12_spelling_variants(spark, sf_dir):
    from threadmill.llm.spelling import group_variants
    return group_variants(scan(spark, sf_dir, "documents"))


@_query(sql.WARC)
def op13_warc(spark, sf_dir):
    from threadmill.llm.warc import archive_round_trip
    return archive_round_trip(scan(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query()
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
