"""Registered query: near-duplicate removal over whole documents."""

from __future__ import annotations


from threadmill.operators.near_dedup import near_dedup
from threadmill.plans import sqltext as S
from threadmill.plans.catalog import register
from threadmill.plans.fixtures import flat_qa
from threadmill.sources.tables import table


@register("near_dedup")
def near_dedup_q(spark, sf_dir):
    """MinHash/LSH candidates, exact-Jaccard verification, exact drop resolution.
    Rows-only at the driver (the signature hashes have no SQL twin); checked against
    a brute-force simulation and the exact-Jaccard pairs in tests."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    th = flat_qa(spark, sf_dir).select("doc_id", "thinking")
    rows = d.join(th, "doc_id")
    return near_dedup(rows, "doc_id", "text", "thinking").select("doc_id", "near_dup")


_SHINGLED = (
    "d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), " + S.q(S.WS + "+") + "), lambda x: x <> '') AS w FROM documents), "
    "s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM d "
    "WHERE len(w) > 0)), "
    "fp AS (SELECT doc_id, md5(string_agg(g, chr(0) ORDER BY g)) AS fp, count(*) AS n FROM s GROUP BY doc_id), "
    "c AS (SELECT fp, min(doc_id) AS rep, any_value(n) AS n FROM fp GROUP BY fp), "
    "r AS (SELECT s.doc_id AS rep, g FROM s JOIN c ON c.rep = s.doc_id)")


@register("similar_pairs", "WITH " + _SHINGLED + ", i AS (SELECT x.rep AS a, y.rep AS b, count(*) AS shared FROM r x JOIN r y ON x.g = y.g AND x.rep < y.rep "
          "GROUP BY ALL) SELECT a, b, shared::INTEGER AS shared, (p.n + q.n - shared)::INTEGER AS total FROM i JOIN c p ON p.rep = a JOIN c q ON q.rep = b "
          "WHERE 100 * shared >= 85 * (p.n + q.n - shared)")
def similar_pairs_q(spark, sf_dir):
    """D2 + J7 with full recall: every pair of distinct shingle sets at Jaccard 0.85 or more, once."""
    from threadmill.operators.prefix_join import similar_pairs
    return similar_pairs(table(spark, sf_dir, "documents"), "doc_id", "text")[0]


@register("similar_classes", "WITH " + _SHINGLED + " SELECT doc_id AS id, rep FROM fp JOIN c USING (fp)")
def similar_classes(spark, sf_dir):
    """The classes of equal shingle sets that ``similar_pairs`` joins: one row per document with words."""
    from threadmill.operators.prefix_join import similar_pairs
    return similar_pairs(table(spark, sf_dir, "documents"), "doc_id", "text")[1]
