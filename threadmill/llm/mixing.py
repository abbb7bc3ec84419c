"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order (hash of seed and id), passed at
most ``max_epochs`` times. A document's virtual finish time is the number of its source's
words up to its own end, divided by the source's target; the mix takes documents in order of
virtual time until the total budget is spent, so that all sources reach their targets together.

Both running sums are split: first by ranges of the shuffle hash within a source, then by
ranges of virtual time over all sources. A first aggregation gives the words of each range,
their prefix sums (one row per range) give the offset of each, and windows only run inside
ranges of bounded size. A source with a third of all rows is spread over many ranges, and a
range that repeated ids overfill is cut into parts.

Defined results: null text has size 0; a null source is a source of its own, last in order. A
null id is shuffled by the hash of its text. Rows that repeat an id are separate documents; their
order is that of size, text hash and row. With no
words at all every target is 0 and nothing is taken. Other columns are not read by ``mix``;
``mixed_documents`` carries them through.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import Scratch

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
RANGE_ROWS = 5_000


def sized(docs: DataFrame) -> DataFrame:
    """row (a number of its own), doc_id, source, size (number of words) and tie (hash of the text) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
                       F.xxhash64(text).alias("tie"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: its size, weight and target.

    A target is the smaller of ``max_epochs`` times the size and ``level * weight``, where the
    level uses up the budget: sources sorted by cap over weight are capped from the front, and
    the first whose share of what is left stays within its cap sets the level for the rest.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_i") % len(weights) + 1).cast("int"))
    per = per.withColumn("_i", F.row_number().over(order) - 1).withColumn("weight", weight).withColumn("_cap", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("weight"), "_i")
    capped = F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    level = (F.lit(float(share)) * total - capped) / rest
    free = per.select("*", level.alias("_level")).withColumn("_free", F.col("_level") * F.col("weight") < F.col("_cap"))
    at = F.min(F.when(F.col("_free"), F.struct(F.col("_cap") / F.col("weight"), "_i", "_level"))).over(Window.partitionBy())
    free = free.withColumn("_at", at).withColumn("_lv", F.col("_at._level"))
    fill = F.least(F.col("_lv") * F.col("weight"), F.col("_cap").cast("double"))
    return free.select("source", "source_size", "weight", F.coalesce(fill, F.col("_cap").cast("double")).alias("target"))


def _running(df: DataFrame, queue: list[str], bucket: Column, part, order: list[Column], limit: int, scratch: Scratch, name: str) -> DataFrame:
    """Adds ``cum``: the words of a queue up to and with each row, in order of bucket, part and ``order``.

    A bucket of more than ``limit`` rows (one id many times, say) is cut into parts: ``part`` makes
    the number of a row's part from the number of parts.
    """
    dealt = scratch.write(df.withColumn("_b", bucket), name)
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(queue)]
    match = lambda extra: reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(queue)], extra)
    load = dealt.groupBy(*queue, "_b").count().where(F.col("count") > limit)
    load = scratch.write(load.select(*keys, F.col("_b").alias("_kb"), F.ceil(F.col("count") / limit).alias("_parts")), f"{name}_hot")
    drop = ["_kb", *[f"_k{i}" for i in range(len(queue))]]
    dealt = dealt.join(load, match(F.col("_b") == F.col("_kb")), "left").drop(*drop)
    dealt = dealt.withColumn("_c", F.when(F.col("_parts").isNotNull(), part(F.col("_parts"))).otherwise(0).cast("long")).drop("_parts")
    sums = dealt.groupBy(*queue, "_b", "_c").agg(F.sum("words").alias("_s"))
    before = F.sum("_s").over(Window.partitionBy(*queue).orderBy("_b", "_c").rowsBetween(Window.unboundedPreceding, -1))
    starts = scratch.write(sums.select(*keys, F.col("_b").alias("_kb"), F.col("_c").alias("_kc"), F.coalesce(before, F.lit(0)).alias("_start")), f"{name}_starts")
    inside = F.sum("words").over(Window.partitionBy(*queue, "_b", "_c").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    ran = dealt.withColumn("_in", inside).join(starts, match((F.col("_b") == F.col("_kb")) & (F.col("_c") == F.col("_kc"))))
    return ran.withColumn("cum", F.col("_start") + F.col("_in")).drop("_start", "_kc", "_b", "_c", "_in", *drop)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = 11,
        range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per row: doc_id, source, tie (hash of its text), size, source_size, target, taken and copies (how often the mix takes it)."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.write(sized(docs), "sizes")
    aim = scratch.write(targets(sizes, weights, share, max_epochs), "targets")
    ranges = max(1, -(-sizes.count() // range_rows))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit(":"), F.col("tie").cast("string")))))
    rows = sizes.select("*", key.alias("key"), F.col("size").alias("words"))
    # range of the shuffle hash: its first 32 bits, cut into equal ranges
    head = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    order = [F.col("key"), F.col("doc_id"), F.col("size"), F.col("tie"), F.col("row")]
    spread = lambda parts: F.pmod(F.xxhash64("tie", "row"), parts)
    queued = _running(rows, ["source"], F.floor(head * ranges / float(1 << 32)).cast("long"), spread, order, 4 * range_rows, scratch, "queue")
    aim = aim.withColumnRenamed("source", "_src")
    queued = scratch.write(queued.join(aim, F.col("source").eqNullSafe(F.col("_src"))).drop("_src"), "queued")
    epoch = F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))
    passes = queued.select("*", epoch.alias("epoch"))
    done = F.col("epoch") * F.col("source_size") + F.col("cum")
    passes = passes.withColumn("finish", F.when(F.col("target") > 0, done / F.col("target"))).where("finish is not null").drop("cum")
    # ranges of virtual time: every source reaches its target at time 1, and no finish time is over max_epochs / share
    bucket = F.floor(F.col("finish") * ranges).cast("long")
    finer = lambda parts: F.floor((F.col("finish") * ranges - F.col("_b")) * parts)
    order = [F.col("finish"), F.col("source").isNull(), F.col("source"), F.col("epoch"), *order]
    timed = _running(passes, [], bucket, finer, order, 4 * range_rows, scratch, "times")
    budget = scratch.write(aim.agg(F.sum("target").alias("_budget")), "budget")
    taken = timed.where(F.col("cum") <= F.lit(budget.scalar()))
    counts = scratch.write(taken.groupBy(F.col("row").alias("_row")).agg(F.count("*").alias("copies")), "taken")
    copies = F.coalesce("copies", F.lit(0)).cast("long")
    return queued.join(counts, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "source", "tie", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows of equal id, source and text are alike: each is taken equally often, and what is left
    over comes from the smallest of them by all columns.
    """
    plan = mix(docs, **options).groupBy(F.col("doc_id").alias("_doc"), F.col("source").alias("_src"), F.col("tie").alias("_tie"))
    plan = Scratch(docs.sparkSession, "mixed").write(plan.agg(F.sum("copies").alias("_n"), F.count("*").alias("_m")).where("_n > 0"), "plan")
    own = (docs["doc_id"].cast("long"), docs["source"].cast("string"), F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))))
    match = lambda p: own[0].eqNullSafe(p["_doc"]) & own[1].eqNullSafe(p["_src"]) & (own[2] == p["_tie"])
    row = F.struct(*(docs[c] for c in docs.columns)).alias("_row")
    repeat = lambda df, n: df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), n))).select("_row.*")
    each = F.floor(F.col("_n") / F.col("_m"))
    out = repeat(docs.join(plan.where("_n >= _m"), match(plan)).select(row, each.alias("_n")), F.col("_n"))
    odd = plan.where("_n % _m > 0").withColumn("_n", F.col("_n") % F.col("_m"))
    if odd.isEmpty():
        return out
    rest = docs.join(odd, match(odd)).groupBy("_doc", "_src", "_tie").agg(F.min(row).alias("_row"), F.first("_n").alias("_n"))
    return out.unionByName(repeat(rest, F.col("_n")))
