import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from threadline.operators import distributions, labels, reports
from threadline.plans import export_queries, staged
from threadline.sources import exports, mapping


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_a_killed_run_goes_on_where_it_broke_off(spark, tmp_path):
    source = spark.range(20).withColumn("x", F.col("id") % 3)
    made = []

    def stages(broken, factor=1):
        def double(df):
            made.append("double")
            return df.withColumn("y", F.col("x") * 2 * factor)

        def total(df):
            made.append("total")
            return df.groupBy("x").agg(F.sum(F.raise_error(F.lit("killed")).cast("long") if broken else F.col("y")).alias("t"))

        return [staged.Stage("double", ("source",), double, {"factor": factor}), staged.Stage("total", ("double",), total), staged.Stage("both", ("double", "total"), lambda a, b: made.append("both") or a.join(b, "x"))]

    folder = str(tmp_path / "run")
    with pytest.raises(Exception, match="killed"):
        staged.run_stages(spark, folder, stages(True), {"source": source})
    assert made == ["double", "total"] and staged.read_manifest(spark, folder, "total") is None
    got = staged.run_stages(spark, folder, stages(False), {"source": source})["both"]
    assert made == ["double", "total", "total", "both"]
    want = staged.run_stages(spark, str(tmp_path / "other"), stages(False), {"source": source})["both"]
    assert rows_of(got) == rows_of(want) and got.count() == 20
    made.clear()
    staged.run_stages(spark, folder, stages(False), {"source": source})
    assert made == []  # all stand
    changed = staged.run_stages(spark, folder, stages(False, 5), {"source": source})["both"]
    assert made == ["double", "total", "both"] and changed.agg(F.max("y")).first()[0] == 20  # new settings are made anew, and all that rests on them
    held = staged.read_manifest(spark, folder, "both")
    assert held["rows"] == 20 and "y:bigint" in held["columns"]


def test_the_chat_run(spark, tmp_path):
    messages = export_queries._roles(export_queries.parsed(spark, SF))
    got = staged.run_stages(spark, str(tmp_path), staged.chat_stages(), {"messages": messages})
    n = got["master"].count()
    assert n == got["full_master"].count() == got["split"].count() and got["split"].groupBy("source_file").agg(F.countDistinct("fold").alias("f")).where("f > 1").isEmpty()
    assert {r["model"] for r in got["models"].collect()} == {"complement_bayes", "multinomial_bayes"} and got["chosen"].count() == 1
    full = got["full_master"]
    assert full.where("predicted is null or normalised = ''").isEmpty() and full.where("(category = predicted) <> (match = 'MATCH')").isEmpty()
    figures = {r["metric"]: r["value"] for r in got["summary"].collect()}
    assert figures["units"] == n and figures["responded"] == full.where("response = 'RESPONSE'").count()
    assert got["categories"].agg(F.sum("total")).first()[0] == n
    whole = got["match"].where("category is null").first()
    assert (whole["total"], whole["matched"]) == (n, full.where("match = 'MATCH'").count())
    exports.write_master(full, f"{tmp_path}/csv", ("sub_id", "category", "transcript"))
    text = spark.read.text(f"{tmp_path}/csv", wholetext=True).first()[0]
    assert text.startswith("﻿sub_id,category,transcript\n")


def test_features_out_and_in(spark, tmp_path):
    weights = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.8), (2, "a", 1.0)], "id long, term string, weight double")
    exports.write_features(weights, spark.createDataFrame([(1, "x"), (2, None)], "id long, label string"), "id", str(tmp_path))
    a, b = exports.read_features(spark, str(tmp_path))
    assert rows_of(a) == rows_of(weights) and b.count() == 2


def test_filters_over_several_columns(spark):
    rows = spark.createDataFrame([(1, "A", "B", "remote"), (2, "B", "A", None), (3, "B", "C", "other"), (4, None, None, "REMOTE")], "id int, one string, two string, r string")
    ids = lambda **f: sorted(r["id"] for r in reports.matching_any(rows, **f).collect())
    assert ids(category=(" A ", ("one", "two"))) == [1, 2] and ids(r_upper=("Remote", ("r",))) == [1, 4]
    assert ids(category=("A", ("one", "two")), r_upper=("remote", ("r",))) == [1] and ids(category=(None, ("one",))) == [1, 2, 3, 4]


def test_media_map_and_warnings(spark):
    chats = spark.createDataFrame([("A",), ("B",)], "chat_id string")
    assigned = spark.createDataFrame([("z/b.jpg", "A", "mentioned"), ("z/a.jpg", "A", "folder"), ("q/c.pdf", None, "unresolved")], "path string, chat_id string, reason string")
    assert {r["chat_id"]: r["media"] for r in mapping.media_map(chats, assigned).collect()} == {"A": ["z/a.jpg", "z/b.jpg"], "B": []}
    assert [tuple(r) for r in mapping.unresolved_media(assigned).collect()] == [("q/c.pdf", "c.pdf", "unable_to_determine_chat")]
    assert mapping.ingest_warnings(chats).collect() == [] and mapping.ingest_warnings(chats.limit(0)).count() == 1


def test_audit_sample_and_cluster_prompts(spark):
    judged = spark.createDataFrame([(i, "WRONG" if i % 2 else "CONSISTENT") for i in range(20)] + [(50, "AMBIGUOUS")], "id int, verdict string")
    assert [r["id"] for r in labels.audit_sample(judged, "id", k=3).orderBy("id").collect()] == [1, 3, 5, 50]
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "id int, text string")
    clusters = spark.createDataFrame([(i, 0 if i < 6 else 1) for i in range(9)], "id int, cluster int")
    got = labels.cluster_prompts(texts, clusters, "id", "text", ["A", "B"], least=5, shown=2).collect()
    assert [(r["cluster"], r["members"]) for r in got] == [(0, 6)] and got[0]["prompt"].endswith("1. text 0\n2. text 1") and "A, B" in got[0]["prompt"]


def test_customers_of_units(spark):
    units = spark.createDataFrame([("a.txt",), ("b.txt",)], "source_file string")
    names = spark.createDataFrame([("a.txt", "Acme"), ("a.txt", "Zeta")], "source_filename string, customer_name string")
    assert {r["source_file"]: r["customer"] for r in distributions.with_customer(units, names).collect()} == {"a.txt": "Acme", "b.txt": "Unknown (b.txt)"}
