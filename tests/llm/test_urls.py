import re

import duckdb
import pytest

from cellstar.llm import urls

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/a", "http://example.com/en/", "http://a.example.com/en/x?y",
    "http://example.com", "http://example.com/de/", "http://xexample.net/fr/1", "http://net/es/", "http://x.net/ES/", "ftp://a.org/a.ZIP",
    "x://y://z.com/q", "http://ads.example.org/x", "http://a.org/login", "http://a.org/loginx", "http://docs.a.org/login?x",
    "http://a.org/a.exe#f", "http://casino7.b.org/", "http://a.org/search/help?utm_source=1", "http://É.org/CART", "http://a.org/\n/cart/",
    "http://a.org/login",
]


def test_beside_sql_with_every_pattern_on_every_url(spark):
    rows = [(i, u, "clash", "clash", i) for i, u in enumerate(URLS)] + [(None, "http://a.org/cart", "", "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string, extra long")
    judged = urls.judge(pages)
    assert judged.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict", "pattern"]
    got = sorted(judged.select("page_id", "host", "path", "rule", "verdict").collect(), key=str)
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", [r[:2] for r in rows])
    assert sorted(map(tuple, got), key=str) == sorted(con.execute(urls.oracle()).fetchall(), key=str)


def test_no_python_in_the_plan_and_empty_table(spark):
    judged = urls.judge(spark.createDataFrame([], "page_id long, url string"))
    assert judged.collect() == []
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("pattern, tokens", [
    ("/login^", ["login"]), (".exe^", ["exe"]), ("||ads.", ["ads"]), ("||casino*.", []), ("login", []), ("@@||docs.*/login^", ["docs", "login"]),
])
def test_whole_tokens_only(pattern, tokens):
    assert urls.pattern_tokens(pattern) == tokens
