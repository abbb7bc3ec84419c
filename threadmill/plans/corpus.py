"""Corpus build over flat question/answer rows (entry 1 of the reference, minimum slice).

documents -> scrub (P11) -> drop reasons (P9, P21) -> exact dedup (D1) -> domain (P22)
-> stratified split (W2) -> counts per (domain, split) (A1).

Everything before the dedup is narrow; dedup is one partial aggregation plus a
join on the unique id; the split adds small per-stratum aggregations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadmill.functions.domain import tag_domain
from threadmill.functions.scrub import scrub_columns
from threadmill.functions.text import first_nonempty
from threadmill.operators.dedup import flag_first_seen, sha256_key
from threadmill.operators.quality import quality_reason
from threadmill.operators.splits import stratified_split
from threadmill.plans.fixtures import flat_qa
from threadmill.session import materialize


def scrubbed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows normalised (P2) and scrubbed (P11): ``doc_id, source, user, answer, thinking``."""
    qa = flat_qa(spark, sf_dir)
    qa = scrub_columns(qa, {"user": first_nonempty("problem"), "answer": first_nonempty("solution")})
    return qa.select("doc_id", "source", "user", "answer", first_nonempty("thinking").alias("thinking"))


def with_drop_reason(rows: DataFrame) -> DataFrame:
    """Reasons in pipeline order: empty prompt/answer, short, refusal, then duplicate prompt.

    The row-level reasons and the dedup key are computed once and written to the
    shared checkpoint folder: the dedup reads that table twice (narrow key columns
    for the winners, full rows for the flag), and nothing upstream is recomputed.
    """
    pre = rows.withColumn(
        "drop_reason",
        F.when((F.col("user") == "") | (F.col("answer") == ""), F.lit("empty"))
        .otherwise(quality_reason("answer"))).withColumn("_dk", sha256_key("user"))
    pre = materialize(pre, "corpus_rows")
    flagged = flag_first_seen(pre, F.col("_dk"), ["doc_id"], "is_first",
                              eligible=F.col("drop_reason").isNull())
    return (flagged.withColumn("drop_reason",
                               F.coalesce("drop_reason", F.when(~F.col("is_first"), F.lit("dup"))))
            .drop("is_first", "_dk"))


def kept_tagged_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = with_drop_reason(scrubbed_rows(spark, sf_dir)).where(F.col("drop_reason").isNull())
    tagged = materialize(kept.withColumn("domain", tag_domain("user")).drop("drop_reason"), "corpus_kept")
    return stratified_split(tagged, "domain", "doc_id")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 over the split corpus: rows and share per (domain, split)."""
    split = kept_tagged_split(spark, sf_dir)
    counts = split.groupBy("domain", "split").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("domain", "split", "n", F.round(F.col("n") / total, 6).alias("share"))


def build_corpus(spark: SparkSession, sources: list[tuple[DataFrame, str, str]], out_path: str | None = None,
                 min_answer_len: int = 50, test_size: float = 0.05) -> DataFrame:
    """Entry 1 end to end: load + tag sources (S1) -> schema dispatch (P3/P4/P6/P8) ->
    quality filter (P9) -> exact dedup on the first user text (D1) -> near dedup (D2) ->
    domain tags (P22) -> stratified split (W2) -> sft/grpo layout (P25, S7).

    Returns rows per (config, split). Row order for "first seen", and the identity of a row, is
    the pair (source rank, row id).
    """
    from threadmill.functions import messages as M
    from threadmill.operators.near_dedup import near_dedup
    from threadmill.plans.q_sources import normalize_any
    from threadmill.sources.io import load_sources

    def checked(x):
        last = M.last_message(x["messages"])
        kept = x["ok"] & quality_reason(last["content"], min_answer_len).isNull()
        return F.struct(kept.alias("kept"), F.when(kept, x["messages"]).alias("messages"),
                        F.when(kept, F.coalesce(M.first_user_text(x["messages"]), F.lit(""))).alias("_user"), F.when(kept, last["thinking"]).alias("_th"))

    # A lambda's argument is computed once and no filter passes the write. As plain columns, the filters
    # and every use of the messages would each normalise the texts anew.
    seen = F.transform(F.array(F.struct("ok", "messages")), checked)[0].alias("_v")
    u = load_sources(spark, [(normalize_any(df).select("_rid", seen), src, model) for df, src, model in sources])
    u = materialize(u, "corpus_build_rows").where("_v.kept")
    u = u.select(F.struct("source_rank", "_rid").alias("_order"), "source", "model", "_v.messages", "_v._user", "_v._th")
    from threadmill.operators.dedup import keep_first_seen
    u = keep_first_seen(u, sha256_key("_user"), ["_order"])
    nd = near_dedup(u.select("_order", "_user", "_th"), "_order", "_user", "_th")
    u = u.join(nd.where(~F.col("near_dup")).select("_order"), "_order", "left_semi")
    u = materialize(u.withColumn("domain", tag_domain("_user")), "corpus_build_kept")
    split = stratified_split(u, "domain", "_order", test_size)
    sft = split.select("messages", "source", "domain", "model", "split")
    grpo = split.select(M.prompt_only("messages").alias("prompt"), "source", "domain", "model", "split")
    if out_path:
        from threadmill.sources.io import write_layout
        write_layout({s: sft.where(F.col("split") == s).drop("split") for s in ("train", "test")},
                     {s: grpo.where(F.col("split") == s).drop("split") for s in ("train", "test")}, out_path)
    counts = split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return (counts.select(F.lit("sft").alias("config"), "split", "n")
            .unionByName(counts.select(F.lit("grpo").alias("config"), "split", "n")))
