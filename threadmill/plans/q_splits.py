"""Registered queries: held-out buckets, splits, samples, leakage and set operations
(W1, W2b, W3, S13, P35, J2, U2, U3, U4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.operators import splits as SP
from threadmill.operators.quality import has_target
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.sources.tables import table

# documents as held-out candidates: session id on two rows of three, the text as completion
_SESS_SQL = "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'S' || CAST(doc_id % 400 AS VARCHAR) END"
_HKEY_SQL = "coalesce(nullif(" + _SESS_SQL + ", ''), 'C:' || substring(coalesce(text, ''), 1, 200))"


def _sessions(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    sess = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("S"), (F.col("doc_id") % 400).cast("string")))
    return d.withColumn("session_id", sess)


@register("holdout_bucket", "SELECT doc_id, (('0x' || md5(" + _HKEY_SQL + "))::UHUGEINT % 20 = 0) AS holdout "
          "FROM documents")
def holdout_bucket(spark, sf_dir):
    """W1 + T7: md5(session id, else 'C:' + completion[:200]) mod 20 = 0."""
    d = _sessions(spark, sf_dir)
    return d.select("doc_id", SP.is_holdout("session_id", "text").alias("holdout"))


@register("holdout_complement", "WITH h AS (SELECT doc_id, (('0x' || md5(" + _HKEY_SQL + "))::UHUGEINT % 20 = 0) AS "
          "holdout FROM documents) SELECT count(*) AS n_all, count(*) FILTER (WHERE holdout) AS n_holdout, "
          "count(*) FILTER (WHERE NOT holdout) AS n_train FROM h")
def holdout_complement(spark, sf_dir):
    """train = all minus held-out; the counts partition the input."""
    d = _sessions(spark, sf_dir).withColumn("holdout", SP.is_holdout("session_id", "text"))
    return d.agg(F.count(F.lit(1)).alias("n_all"), F.count_if("holdout").alias("n_holdout"),
                 F.count_if(~F.col("holdout")).alias("n_train"))


@register("leakage_guard", "WITH h AS (SELECT " + _HKEY_SQL + " AS k, (('0x' || md5(" + _HKEY_SQL
          + "))::UHUGEINT % 20 = 0) AS holdout, length(" + S.strip("coalesce(text, '')") + ") > 16 AS target FROM documents) "
          "SELECT count(*) FILTER (WHERE holdout AND target) AS n_held, count(*) FILTER (WHERE NOT holdout) AS n_train, "
          "count(*) FILTER (WHERE NOT holdout AND k IN (SELECT k FROM h WHERE holdout AND target)) AS n_leaked FROM h")
def leakage_guard(spark, sf_dir):
    """Train rows whose held-out key (W1) also occurs among the evaluated held-out rows, over all rows.

    Both sides are counted in one aggregation by key, which takes the place of a join.
    """
    d = _sessions(spark, sf_dir).withColumn("k", SP.holdout_key("session_id", "text"))
    d = d.select("k", SP.is_holdout("session_id", "text").alias("holdout"), has_target("text").alias("target"))
    keys = d.groupBy("k").agg(F.count_if(F.col("holdout") & F.col("target")).alias("held"), F.count_if(~F.col("holdout")).alias("train"))
    return keys.agg(F.coalesce(F.sum("held"), F.lit(0)).alias("n_held"), F.coalesce(F.sum("train"), F.lit(0)).alias("n_train"),
                    F.coalesce(F.sum(F.when(F.col("held") > 0, F.col("train"))), F.lit(0)).alias("n_leaked"))


@register("global_split", "WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY " + S.md5_key(42, "doc_id")
          + ") AS hr, count(*) OVER () AS n FROM documents) SELECT doc_id, CASE WHEN hr <= ceil(n * 0.05::DOUBLE) "
          "THEN 'test' ELSE 'train' END AS split FROM r")
def global_split(spark, sf_dir):
    """Seeded 5 % test split (ceil), distributed cutoff instead of a global sort."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    return SP.seeded_global_split(d, "doc_id")


@register("seeded_sample", "SELECT doc_id FROM documents ORDER BY " + S.md5_key(42, "doc_id") + " LIMIT 500")
def seeded_sample(spark, sf_dir):
    """Seeded shuffled sample of 500 documents (the limit is the operator)."""
    return SP.seeded_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 500)


@register("row_cap", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 100")
def row_cap(spark, sf_dir):
    """First N rows in id order (a row cap is the operator; an order makes it defined)."""
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy("doc_id").limit(100)


@register("first_n_per_source", "WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY "
          "doc_id) AS rn FROM documents) SELECT doc_id, source, rn FROM r WHERE rn <= 2000")
def first_n_per_source(spark, sf_dir):
    """First 2000 rows per source in one scan (salted pre-rank, no whole-group window)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return SP.first_n_per_group(d, "source", "doc_id", 2000).select("doc_id", "source",
                                                                     F.col("rn").cast("long").alias("rn"))


@register("uniqueness", "SELECT count(*) AS n, count(DISTINCT text) AS n_distinct, count(DISTINCT text) = count(*) "
          "AS all_unique FROM documents")
def uniqueness(spark, sf_dir):
    """Distinct count / uniqueness test."""
    d = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("key"))
    return d.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("key").alias("n_distinct"),
                 (F.count_distinct("key") == F.count(F.lit(1))).alias("all_unique"))


@register("benchmark_overlap", "SELECT count(*) AS n_overlap FROM (SELECT DISTINCT " + S.strip("l") + " AS k FROM "
          "(SELECT unnest(string_split(text, chr(10))) AS l FROM documents) WHERE " + S.strip("l") + " <> '' "
          "INTERSECT SELECT DISTINCT " + S.strip("l") + " FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM "
          "benchmark))")
def benchmark_overlap(spark, sf_dir):
    """U4: overlap of two key sets: document lines that are benchmark lines (contamination)."""
    from threadmill.functions.text import strip

    def lines(name):
        t = table(spark, sf_dir, name).select(F.explode(F.split("text", "\n")).alias("l"))
        return t.select(strip("l").alias("k")).where(F.col("k") != "")

    # a benchmark line is kept once; only document lines that are one are shuffled to be counted
    hit = lines("documents").join(lines("benchmark").distinct(), "k", "left_semi")
    return hit.agg(F.count_distinct("k").alias("n_overlap"))
