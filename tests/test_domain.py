"""The guarded domain rules against the plain rules, case folding included."""

import random
import re

from pyspark.sql import functions as F

from threadmill.functions import domain as DM


def plain(c):
    out = None
    for name, pattern in DM.DOMAIN_RULES:
        cond = F.coalesce(F.col(c), F.lit("")).rlike("(?iUd)" + pattern)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(DM.DEFAULT_DOMAIN))


def test_every_alternative_has_literals():
    for name, pattern in DM.DOMAIN_RULES:
        parts = DM._parts(pattern)
        assert "|".join(parts) == pattern
        for p in parts:
            lits = DM._literals(p)
            assert lits and all(x and x == x.lower() for x in lits)
            re.compile(p)


def test_guarded_rules_match_the_plain_ones(spark):
    rnd = random.Random(7)
    bits = ["code", "Function", "CLAſS", "clas", "s", "algorıthm", "ALGORİTHM", "python", "programming", "solve", "proofs", "$", "a$b", "\\frac", "\\sum", "\\in",
            "12", "3 ", "+", " - ", "*", "/", "^", "٣", " + ", "force", "forces", "enforce", "logİc", "valid", "invalid", "sound", "ſound", "art", "party", "music",
            "Ethics", "x", " ", "\n", "```", "_", "é", "İ", "ſ", "K"]
    texts = [None, "", "1" * 4000, "1" * 2000 + " + x", "7 ^ 8", "7 ^", "$\n$"]
    texts += ["".join(rnd.choice(bits) + rnd.choice(["", " ", " "]) for _ in range(rnd.randint(1, 6))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    bad = df.withColumn("a", DM.tag_domain("t")).withColumn("b", plain("t")).where("a <> b").collect()
    assert not bad
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert docs.withColumn("a", DM.tag_domain("text")).withColumn("b", plain("text")).where("a <> b").isEmpty()
