import random

import duckdb
from pyspark.sql import functions as F

from threadline.llm import url_filter

SCHEMA = "page_id long, url string, host int, template string, n string"


def test_hosts_paths_and_rules(spark):
    urls = {
        "http://X.Example.ORG/es/1?a=/fr/": ("x.example.org", "/es/1", "example.org/es/", "block"), "HTTPS://org/": ("org", "/", "org/", "allow"), "a://b.org": ("b.org", "", None, "allow"),
        "a://b.org?x=/es/": ("b.org", "", None, "allow"), "//b.com/de/": ("", "", None, "allow"), "x://y.com/de/http://z.org/": ("y.com", "/de/http://z.org/", "com/de/", "block"), "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://example.org/en/19": ("example.org", "/en/19", "example.org/en/1", "block"), "http://É.com/fr#/": ("É.com", "/fr", None, "allow"), "http://a.com:80/de/": ("a.com:80", "/de/", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "://": ("", "", None, "allow"), "http:///fr/": ("", "/fr/", None, "allow"), "http://m.com/de/\nx": ("m.com", "/de/\nx", "com/de/", "block"),
    }
    rows = spark.createDataFrame([(i, u, 1, "t", "n") for i, u in enumerate(urls)], SCHEMA)
    got = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(rows).collect()}
    assert got == urls
    assert url_filter.judge_urls(rows.limit(0)).collect() == []


def test_templates_of_a_host(spark):
    """Labelled sections: a bad one is rejected and its unlabelled pages with it, alike ones merge, one without labels stays apart."""
    rows = [(f"http://h.test/{kind}/{name}{i}.html", label if i % 2 else None) for kind, label in (("spam", 1), ("news", 0), ("blog", 0)) for i, name in enumerate(["a"] * 60)]
    rows += [(f"http://h.test/new/{i}", None) for i in range(40)] + [(f"http://h.test/{chr(97 + i % 26)}{chr(97 + i // 26)}/about", None) for i in range(300)]
    rows += [(f"http://other.test/spam/{i}.html", None) for i in range(30)]
    pages = spark.createDataFrame(rows, "url string, bad long")
    got = url_filter.judge_urls(pages, (), label=F.col("bad")).collect()
    templates = {r["url"].split("/")[3]: r["template"] for r in got if "h.test" in r["url"]}
    assert {k: templates[k] for k in ("spam", "news", "blog", "new", "aa")} == {"spam": "/spam/<*>.html", "news": "/{blog,news}/<*>.html", "blog": "/{blog,news}/<*>.html", "new": "/new/<*>", "aa": "/<*>/about"}
    assert {r["url"].split("/")[3] for r in got if r["verdict"] == "block"} == {"spam"}
    assert all(r["verdict"] == "allow" for r in got if "other.test" in r["url"])
    assert len(got) == len(rows)


def test_against_sql_on_odd_urls(spark, tmp_path):
    rng = random.Random(3)
    hosts = ["a.com", "b.a.com", "example.org", "x.example.org", "c.net", "D.NET", "é.net", "org"]
    parts = ["en", "de", "fr", "es", "", "a1", "x.html", "7.tar.gz", "new s", "ü2", "v1.2", "p\nq", "<*>"]
    urls = [None, "", "a://", "a://b"] + [f"{rng.choice(['http', 'S'])}://{rng.choice(hosts)}" + "".join("/" + rng.choice(parts) for _ in range(rng.randrange(10))) + rng.choice(["", "?q=/de/", "#x"]) for _ in range(1500)]
    folder = f"{tmp_path}/pages.parquet"
    spark.createDataFrame([(i // 2, u) for i, u in enumerate(urls)], "page_id long, url string").write.parquet(folder)
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{folder}/*.parquet'")
    names = ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    plain = lambda rows: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in rows)
    want = con.execute(f"select {', '.join(names)} from ({url_filter.ORACLES['op11_url_templates']})").fetchall()
    assert plain(url_filter.op11_url_templates(spark, str(tmp_path)).select(*names).collect()) == plain(want)
