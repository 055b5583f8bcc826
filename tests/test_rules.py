from pyspark.sql import functions as F

from meterline.functions import rules
from meterline.sources.ingest import tags_to_map


def test_license_tier_substring_and_nulls(spark):
    df = spark.createDataFrame([("Product Catalog", None), ("QA", None), (None, None), ("x", "Critical billing")],
                               "n string, d string")
    got = [r[0] for r in df.select(rules.license_tier("n", "d")).collect()]
    assert got == ["Peak", "Pro", "Pro", "Peak"]


def test_architecture_boundaries(spark):
    df = spark.createDataFrame([(4, 1), (2, 10), (2, 9), (1, 100), (None, None)], "t int, n int")
    got = [r[0] for r in df.select(rules.architecture_name("t", "n")).collect()]
    assert got == ["Microservices", "Microservices", "Monolithic", "Monolithic", "Monolithic"]


def test_tags_first_non_empty_last_wins_unnamed_dropped(spark):
    df = spark.createDataFrame(
        [([("h-code", ""), ("hcode", "X"), ("", "junk"), (None, "y")],),
         ([("h_code", "A"), ("h_code", "B")],),
         ([("h-code", "Z"), ("h_code", "A")],)],
        "tags array<struct<name:string,value:string>>")
    m = df.select(tags_to_map(F.col("tags")).alias("m"))
    got = [r[0] for r in m.select(rules.hcode_from_tags("m")).collect()]
    assert got == ["X", "B", "Z"]
    assert m.select(F.size("m")).collect()[0][0] == 2


def test_safe_truncate_and_bool(spark):
    df = spark.createDataFrame([("", "true"), ("abcdef", "yes"), (None, "no"), ("ab", None)], "s string, b string")
    r = df.select(rules.safe_truncate("s", 3).alias("t"), rules.loose_bool("b").alias("b")).collect()
    assert [x.t for x in r] == [None, "abc", None, "ab"]
    assert [x.b for x in r] == [True, True, False, False]


def test_safe_ratio_and_labels(spark):
    df = spark.createDataFrame([(1.0, 0.0, "Peak"), (1.0, 4.0, "Pro"), (2.0, None, "Other")], "n double, d double, t string")
    r = df.select(rules.safe_ratio("n", "d").alias("r"), rules.tier_label("t").alias("l")).collect()
    assert [x.r for x in r] == [0, 0.25, 0]
    assert r[2].l == "Other"
