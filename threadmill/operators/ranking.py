"""Exact, distributed "first k rows in hash order" per group.

Seeded shuffles and splits in the reference are "shuffle, take the first k". With
a uniform hash as the order key this is "rank <= k" for a data-dependent k (5 % of a
stratum). A ``row_number`` window cannot do that at scale: it puts a whole stratum,
possibly a third of the corpus, into one task; ``orderBy().limit(k)`` merges k rows in
one task as well.

Instead the k-th key of each group is found by histogram refinement on hex prefixes
of the hash. Each level is a partial (map-side combined) ``groupBy`` count over at
most 2**16 buckets per group, narrowing to the bucket that holds the k-th key. After
two levels the remaining bucket holds about n / 2**32 rows and is ranked exactly.
Every row is then compared with its group's cutoff key, a table with one row per
group. The last bucket is ranked by distinct keys and their counts, so rows that repeat a
key never meet in one task. Where the cutoff key itself repeats (repeated or null ids), only
its rows are written, numbered, and cut by the hash of their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.session import materialize

_LEVELS = ((1, 4), (5, 4))  # (start, length) of hex prefixes: 16 bits per level


def md5_order_key(seed: int | str, *id_cols: str) -> Column:
    """Order key ``md5(seed ':' id ...)`` as hex text."""
    parts: list[Column] = [F.lit(str(seed))]
    for c in id_cols:
        parts += [F.lit(":"), F.coalesce(F.col(c).cast("string"), F.lit(""))]   # a null id has the key of the empty text
    return F.md5(F.concat(*parts))


#: Groups whose values are sent to all executors, so that their rows stay where they are.
FEW_GROUPS = 10_000


def few(table: DataFrame) -> DataFrame:
    """``table`` (written, or cheap to count), marked for broadcast if it is short: in a shuffled join all rows
    of a large group, with all their columns, would meet in one task."""
    return F.broadcast(table) if table.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS else table


def _attach(rows: DataFrame, table: DataFrame, g: list[str], how: str = "inner") -> DataFrame:
    """Attach per-group values: null-safe equi-join (a null group is a group; AQE broadcasts
    what it measures to be small), or scalar subqueries when ungrouped."""
    if g:
        named = table.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)], *[c for c in table.columns if c not in g])
        same = F.lit(True)
        for i, c in enumerate(g):
            same = same & rows[c].eqNullSafe(F.col(f"_g{i}"))
        return rows.join(named, same, how).drop(*[f"_g{i}" for i in range(len(g))])
    return rows.select("*", *[table.select(c).scalar().alias(c) for c in table.columns])


def kth_key(df: DataFrame, key_col: str, group_cols: list[str],
            k_of_n: Callable[..., Column], given: str | None = None) -> DataFrame:
    """Return ``(group..., _n, _k, _cut, _take, _tied)`` where ``_cut`` is the k-th smallest key.

    ``k_of_n`` maps the group size (and the group's value of the column ``given``) to k; k is clipped to [0, n] and ``_cut`` is null
    when k = 0. ``_tied`` rows have the key ``_cut``, of which ``_take`` are among the first k.
    """
    g = list(group_cols)
    keys = df.select(*g, F.col(key_col).alias("_key"))
    more = [F.first(given).alias("_g")] if given else []
    sizes = df.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), *more)
    k = k_of_n(F.col("_n"), *([F.col("_g")] if given else []))
    sizes = sizes.select(*g, "_n", F.greatest(F.lit(0), F.least(k.cast("long"), F.col("_n"))).alias("_k"))
    # The per-group state is tiny (one row per group); it is checkpointed after each
    # level so later levels do not re-derive earlier ones (the plan would otherwise
    # grow as 2**levels copies of the size aggregation).
    state = sizes.select(*g, "_n", "_k", F.col("_k").alias("_need")).checkpoint()
    cand = keys
    bounds: list[str] = []
    for level, (start, length) in enumerate(_LEVELS):
        rows = _attach(cand, few(state.drop("_n", "_k")) if g else state.select(*bounds, "_need"), g)
        for i, b in enumerate(bounds):
            rows = rows.where(F.substring("_key", *_LEVELS[i]) == F.col(b))
        p = F.substring("_key", start, length).alias("_p")
        hist = rows.groupBy(*g, p).agg(F.count(F.lit(1)).alias("_c"), F.first("_need").alias("_need"))
        w = Window.partitionBy(*g).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("_cum", F.sum("_c").over(w))
        pick = (hist.where(F.col("_cum") >= F.col("_need"))
                .groupBy(*g)
                .agg(F.min(F.struct("_p", (F.col("_need") - F.col("_cum") + F.col("_c")).alias("_r")))
                     .alias("_b")))
        bname = f"_B{level}"
        pick = pick.select(*g, F.col("_b._p").alias(bname), F.col("_b._r").alias("_need2"))
        keep = [*g, "_n", "_k", *bounds]
        if g:
            state = _attach(state.select(*keep), pick, g, "left")
        else:
            state = state.select(*keep).select("*", *[pick.select(c).scalar().alias(c)
                                                     for c in (bname, "_need2")])
        state = state.withColumnRenamed("_need2", "_need").checkpoint()
        bounds.append(bname)
        cand = keys
    rows = _attach(keys, few(state.select(*g, *bounds, "_need").where(F.col("_need").isNotNull())) if g
                   else state.select(*bounds, "_need"), g)
    for i, b in enumerate(bounds):
        rows = rows.where(F.substring("_key", *_LEVELS[i]) == F.col(b))
    rows = rows.groupBy(*g, "_key").agg(F.count(F.lit(1)).alias("_c"), F.first("_need").alias("_need"))
    w = Window.partitionBy(*g).orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    upto = rows.withColumn("_cum", F.sum("_c").over(w)).where((F.col("_cum") >= F.col("_need")) & (F.col("_need") > 0))
    first = F.min(F.struct("_key", (F.col("_need") - F.col("_cum") + F.col("_c")).alias("t"), F.col("_c"))).alias("_b")
    last = upto.groupBy(*g).agg(first).select(*g, F.col("_b._key").alias("_cut"), F.col("_b.t").alias("_take"), F.col("_b._c").alias("_tied"))
    if g:
        return _attach(state.select(*g, "_n", "_k"), last, g, "left").checkpoint()
    return state.select("_n", "_k", *[last.select(c).scalar().alias(c) for c in ("_cut", "_take", "_tied")]).checkpoint()


def flag_first_k(df: DataFrame, key_col: str, group_cols: list[str],
                 k_of_n: Callable[[Column], Column], out_col: str) -> DataFrame:
    """Add boolean ``out_col``: the row is among the first k of its group, in order of the key.

    Of rows that share the cutoff key as many are flagged as k leaves, chosen by the hash of
    their row number; other rows that repeat a key fall on one side together.
    """
    g = list(group_cols)
    cuts = kth_key(df, key_col, g, k_of_n)
    ends = cuts.select(*g, "_cut", F.when(F.col("_take") < F.col("_tied"), F.col("_take")).alias("_some"))
    joined = _attach(df, few(ends) if g else ends, g)
    flag = F.coalesce(F.col(key_col) <= F.col("_cut"), F.lit(False))
    out = joined.withColumn(out_col, flag)
    if cuts.where("_take < _tied").isEmpty():
        return out.drop("_cut", "_some")
    at_cut = F.col("_some").isNotNull() & F.col(key_col).eqNullSafe(F.col("_cut"))
    rest = out.where(~at_cut).drop("_cut", "_some")
    tied = materialize(out.where(at_cut).drop(out_col, "_cut").withColumn("_rid", F.monotonically_increasing_id()), "ties")
    tied = tied.withColumn("_rk", F.md5(F.col("_rid").cast("string")))
    cut = kth_key(tied, "_rk", g, lambda n, some: some, "_some")
    tied = _attach(tied, cut.select(*g, "_cut"), g)
    tied = tied.withColumn(out_col, F.coalesce(F.col("_rk") <= F.col("_cut"), F.lit(False))).drop("_cut", "_some", "_rid", "_rk")
    return rest.unionByName(tied)


def cut_keys(df: DataFrame, key_col: str, borders: list[int]) -> list[str | None]:
    """The keys at many ranks (1-based) from one refined histogram; null where a rank exceeds the rows.

    The first histogram (at most 2**16 buckets of the hash) serves all ranks; the second counts
    only the buckets that hold one, and the last step the distinct keys of about n / 2**32 rows
    a rank. The driver receives one row per rank.
    """
    spark = df.sparkSession
    keys = df.select(F.col(key_col).alias("_key"))
    want = spark.createDataFrame([(i, b) for i, b in enumerate(borders)], "i int, need long")
    for start, length in _LEVELS:
        p = F.substring("_key", 1, start + length - 1)
        hist = keys.groupBy(p.alias("_p")).agg(F.count(F.lit(1)).alias("_c")) if start == 1 else \
            keys.join(F.broadcast(want.select("_q").distinct()), F.substring("_key", 1, start - 1) == F.col("_q")).groupBy("_q", p.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
        part = Window.partitionBy(*(["_q"] if start > 1 else [])).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("_cum", F.sum("_c").over(part))
        same = hist["_q"].eqNullSafe(want["_q"]) if start > 1 else F.lit(True)
        met = want.join(hist, same & (F.col("_cum") >= F.col("need")) & (F.col("_cum") - F.col("_c") < F.col("need")))
        want = met.select("i", (F.col("need") - F.col("_cum") + F.col("_c")).alias("need"), F.col("_p").alias("_q")).checkpoint()
    width = _LEVELS[-1][0] + _LEVELS[-1][1] - 1
    last = keys.join(F.broadcast(want.select("_q").distinct()), F.substring("_key", 1, width) == F.col("_q")).groupBy("_q", "_key").agg(F.count(F.lit(1)).alias("_c"))
    last = last.withColumn("_cum", F.sum("_c").over(Window.partitionBy("_q").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)))
    found = want.join(last, (last["_q"] == want["_q"]) & (F.col("_cum") >= F.col("need")) & (F.col("_cum") - F.col("_c") < F.col("need")))
    got = {r["i"]: r["_key"] for r in found.select("i", "_key").collect()}
    return [got.get(i) for i in range(len(borders))]
