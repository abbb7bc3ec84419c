"""Registered queries: corpus build over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.plans import corpus
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register

_ROWS = (
    "WITH " + S.FLAT + ", rows AS (SELECT doc_id, source, " + S.scrub("problem") + " AS user, "
    + S.scrub("solution") + " AS answer, nullif(thinking, '') AS thinking FROM flat)"
)
_REASON = (
    _ROWS + ", pre AS (SELECT *, CASE WHEN user = '' OR answer = '' THEN 'empty' "
    "WHEN length(answer) < 50 THEN 'short' WHEN " + S.refusal("answer") + " THEN 'refusal' END AS r0 FROM rows)"
    ", ranked AS (SELECT *, CASE WHEN r0 IS NULL THEN row_number() OVER (PARTITION BY r0 IS NULL, "
    "sha256(" + S.strip("user") + ") ORDER BY doc_id) END AS rn FROM pre)"
    ", reasoned AS (SELECT *, coalesce(r0, CASE WHEN rn > 1 THEN 'dup' END) AS drop_reason FROM ranked)"
)
_SPLIT = (
    _REASON + ", tagged AS (SELECT *, " + S.domain("user") + " AS domain FROM reasoned WHERE drop_reason IS NULL)"
    ", sizes AS (SELECT domain, count(*) AS sn FROM tagged GROUP BY domain)"
    ", eff AS (SELECT t.*, CASE WHEN (SELECT min(sn) FROM sizes) >= 2 THEN domain ELSE '*' END AS stratum "
    "FROM tagged t)"
    ", r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY " + S.md5_key(42, "doc_id") + ") AS hr, "
    "count(*) OVER (PARTITION BY stratum) AS n_s FROM eff)"
    ", split AS (SELECT *, CASE WHEN hr <= greatest(1, floor(n_s * 0.05::DOUBLE)) THEN 'test' "
    "ELSE 'train' END AS split FROM r)"
)


@register("corpus_split_counts", _SPLIT + " SELECT domain, split, count(*) AS n, "
          "round(count(*) / sum(count(*)) OVER (), 6) AS share FROM split GROUP BY domain, split")
def corpus_split_counts(spark, sf_dir):
    """Flagship: scrub -> drop reasons -> exact dedup -> domain -> stratified split -> A1."""
    return corpus.split_counts(spark, sf_dir)


@register("drop_reason_counts", _REASON + " SELECT coalesce(drop_reason, 'kept') AS reason, "
          "count(*) AS n FROM reasoned GROUP BY 1")
def drop_reason_counts(spark, sf_dir):
    """First reason per row, kept + dropped = input."""
    from threadmill.operators.quality import reason_counts
    return reason_counts(corpus.with_drop_reason(corpus.scrubbed_rows(spark, sf_dir)))


@register("scrub_text", "WITH " + S.NOISY + " SELECT doc_id, " + S.scrub("text") + " AS clean, "
          "length(" + S.scrub("text") + ")::BIGINT AS clean_len FROM noisy")
def scrub_text(spark, sf_dir):
    """P11 over whole documents (noise appended to every fifth)."""
    from threadmill.functions.scrub import scrub_columns
    from threadmill.plans.fixtures import noisy_documents
    d = scrub_columns(noisy_documents(spark, sf_dir), {"clean": "text"})
    return d.select("doc_id", "clean", F.length("clean").cast("long").alias("clean_len"))


@register("exact_dedup_first_seen", "WITH d AS (SELECT doc_id, row_number() OVER (PARTITION BY sha256("
          + S.strip("text") + ") ORDER BY doc_id) AS rn FROM documents) SELECT doc_id FROM d WHERE rn = 1")
def exact_dedup_first_seen(spark, sf_dir):
    """D1 on whole documents: first doc_id per sha256(strip(text))."""
    from threadmill.operators.dedup import keep_first_seen, sha256_key
    from threadmill.sources.tables import table
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return keep_first_seen(d, sha256_key("text"), ["doc_id"]).select("doc_id")


@register("domain_tags", "SELECT doc_id, " + S.domain("text") + " AS domain FROM documents")
def domain_tags(spark, sf_dir):
    """P22 on every document text."""
    from threadmill.functions.domain import tag_domain
    from threadmill.sources.tables import table
    return table(spark, sf_dir, "documents").select("doc_id", tag_domain("text").alias("domain"))


_TRAIN = (_SPLIT + ", tr AS (SELECT doc_id, source, domain, user, answer, thinking FROM split WHERE split = 'train')")


_CHECKS_SQL = (
    _TRAIN + ", m AS (SELECT [struct_pack(role := 'user', content := " + S.strip("user") + "), struct_pack(role := "
    "'assistant', content := " + S.strip("answer") + ")] AS m FROM tr), p AS (SELECT m, list_filter(m, lambda x: x.role "
    "<> 'assistant') AS pr FROM m), c AS (SELECT count(*) FILTER (WHERE NOT list_contains(list_transform(m, lambda x: "
    "x.role), 'user')) AS has_user, count(*) FILTER (WHERE NOT list_contains(list_transform(m, lambda x: x.role), "
    "'assistant')) AS has_assistant, count(*) FILTER (WHERE coalesce(m[-1].role, '') <> 'assistant') AS "
    "last_is_assistant, count(*) FILTER (WHERE length(coalesce(m[-1].content, '')) < 50) AS min_answer_len, "
    "count(*) FILTER (WHERE coalesce(pr[-1].role, '') <> 'user') AS grpo_last_user, count(*) FILTER (WHERE "
    "list_bool_or(list_transform(pr, lambda x: x.role = 'assistant'))) AS grpo_no_assistant FROM p), "
    "u AS (SELECT count(*) - count(DISTINCT x.content) AS v FROM (SELECT unnest(list_filter(m, lambda y: y.role = "
    "'user')) AS x FROM m)) "
    "SELECT \"check\", violations, violations = 0 AS passed FROM (UNPIVOT c ON has_user, has_assistant, "
    "last_is_assistant, min_answer_len, grpo_last_user, grpo_no_assistant INTO NAME \"check\" VALUE violations) "
    "UNION ALL SELECT 'unique_user_prompts', v, v = 0 FROM u"
)


@register("corpus_checks", _CHECKS_SQL)
def corpus_checks(spark, sf_dir):
    """Publish checks over every train row of the corpus build (not a 200-row prefix)."""
    from threadmill.functions.messages import from_flat
    from threadmill.operators.stats import assertion_suite
    tr = corpus.kept_tagged_split(spark, sf_dir).where(F.col("split") == "train")
    sft = tr.select(from_flat("user", "answer", "thinking")["messages"].alias("messages"))
    return assertion_suite(sft)


@register("corpus_card", _SPLIT + ", t AS (SELECT count(*) AS n FROM split) SELECT 'source' AS section, source AS key, "
          "count(*) AS n, round(count(*) * 100.0 / (SELECT n FROM t), 6)::DOUBLE AS pct FROM split GROUP BY source "
          "UNION ALL SELECT 'domain', domain, count(*), round(count(*) * 100.0 / (SELECT n FROM t), 6)::DOUBLE FROM split "
          "GROUP BY domain UNION ALL SELECT 'thinking', 'with_thinking', count(*) FILTER (WHERE thinking IS NOT NULL), "
          "round(count(*) FILTER (WHERE thinking IS NOT NULL) * 100.0 / (SELECT n FROM t), 6)::DOUBLE FROM split "
          "UNION ALL SELECT 'total', 'all', (SELECT n FROM t), 100.0::DOUBLE")
def corpus_card(spark, sf_dir):
    """A22 (+A1, A2): corpus card tables as rows (section, key, n, pct)."""
    from threadmill.operators.stats import count_share
    s = corpus.kept_tagged_split(spark, sf_dir)
    s = s.cache()  # four small aggregations over the same split; recomputed from lineage if evicted
    src = count_share(s, "source", "key").select(F.lit("source").alias("section"), "key", "n", "pct")
    dom = count_share(s, "domain", "key").select(F.lit("domain").alias("section"), "key", "n", "pct")
    th = s.agg(F.count_if(F.col("thinking").isNotNull()).alias("n"), F.count(F.lit(1)).alias("t"))
    th = th.select(F.lit("thinking").alias("section"), F.lit("with_thinking").alias("key"), "n",
                   F.round(F.col("n") * 100.0 / F.col("t"), 6).alias("pct"))
    tot = s.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total").alias("section"), F.lit("all").alias("key"), "n",
                                                      F.lit(100.0).alias("pct"))
    return src.unionByName(dom).unionByName(th).unionByName(tot)


@register("consumer_filter", _TRAIN + " SELECT doc_id FROM tr WHERE domain = 'general' AND contains(source, '1') AND "
          "thinking IS NOT NULL")
def consumer_filter(spark, sf_dir):
    """Consumer-side filters: domain equals, source/model contains, thinking present."""
    s = corpus.kept_tagged_split(spark, sf_dir).where(F.col("split") == "train")
    return s.where((F.col("domain") == "general") & F.contains("source", F.lit("1")) & F.col("thinking").isNotNull()) \
        .select("doc_id")


@register("corpus_build_full")
def corpus_build_full(spark, sf_dir):
    """Entry 1 end to end over documents (flat rows) and conversations (turn arrays), with
    near dedup and the sft/grpo layout written to the shared checkpoint folder.
    Rows-only (the near-dedup step has no SQL twin)."""
    import uuid

    from threadmill.plans.fixtures import conv_raw, flat_qa
    from threadmill.session import checkpoint_dir
    docs = flat_qa(spark, sf_dir).drop("source").withColumnRenamed("doc_id", "_rid")
    convs = conv_raw(spark, sf_dir).withColumnRenamed("conv_id", "_rid")
    out = f"{checkpoint_dir(spark).rstrip('/')}/layouts/corpus-{uuid.uuid4().hex}"
    return corpus.build_corpus(spark, [(docs, "documents", "model-a"), (convs, "conversations", "model-b")], out)
