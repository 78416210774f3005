import random

from pyspark.sql import functions as F

from threadline.functions import text as T
from threadline.operators import dictionary


def tables(spark, domain, general, protected):
    pairs = "word string, replacement string"
    return dictionary.dictionary(spark.createDataFrame(list(domain.items()), pairs), spark.createDataFrame(list(general.items()), pairs), spark.createDataFrame([(w,) for w in protected], "word string"))


def test_table_against_the_expression(spark):
    rng = random.Random(4)
    word = lambda: "".join(c * rng.choice([1, 1, 1, 2, 3, 5]) for c in rng.choices("abéx", k=rng.randrange(1, 5)))
    domain, general, protected = {word(): "d" + word() for _ in range(40)}, {word(): "g" + word() for _ in range(60)}, tuple({word() for _ in range(20)})
    texts = [" ".join(word() for _ in range(rng.randrange(30))) for _ in range(200)] + ["", None, "  ", "a " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, c string")
    want = {r["i"]: (r["normalised"], r["changed"]) for r in T.normalised_texts(docs, "c", domain, general, protected).collect()}
    for frequent in (0, 30, 100_000):
        got = dictionary.normalised_by_table(docs, "i", "c", tables(spark, domain, general, protected), frequent)
        assert {r["i"]: (r["normalised"], r["changed"]) for r in got.collect()} == want
    assert dictionary.normalised_by_table(docs.limit(0), "i", "c", tables(spark, domain, general, protected)).collect() == []


def test_a_hundred_thousand_words(spark):
    pairs = spark.range(100_000).select(F.format_string("w%d", "id").alias("word"), F.format_string("v%d", "id").alias("replacement"))
    table = dictionary.dictionary(pairs, pairs.where("false"), pairs.where("word = 'w7'").select("word"))
    docs = spark.range(500).select(F.col("id").alias("i"), F.concat_ws(" ", F.lit("w7 w77777 w77777 plain"), F.format_string("w%d w%d", F.col("id") * 200, F.col("id") + 1_000_000)).alias("c"))
    got = {r["i"]: (r["normalised"], r["changed"]) for r in dictionary.normalised_by_table(docs, "i", "c", table, 1000).collect()}
    assert got[3] == ("w7 v77777 v77777 plain v600 v103", 4)  # w1000003 is no word; with its zeros reduced it is w103
    assert got[120] == ("w7 v77777 v77777 plain v24000 v10120", 4)  # reduced w10120
    assert len(got) == 500
