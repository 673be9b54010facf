from ledgerloom.sql import register


def test_sql_names(spark):
    register(spark)
    page = "<main><h2>H</h2><a href=\"b\">B</a><table><tr><th>x</th></tr><tr><td>1</td></tr></table></main>"
    spark.createDataFrame([("https://h/a", page), ("https://h/n", None)], "url string, body string").createOrReplaceTempView("sql_pages")
    links = spark.sql("SELECT p.url, l.* FROM sql_pages p, LATERAL page_links(p.body, p.url) l").collect()
    assert [tuple(r) for r in links] == [("https://h/a", 0, "B", "https://h/b", "H")]
    cells = spark.sql("SELECT t.value, t.header FROM sql_pages p, LATERAL page_tables(p.body, p.url) t").collect()
    assert [tuple(r) for r in cells] == [("1", "x")]
    assert spark.sql("SELECT join_url('https://h/a/', '../b') AS j, quote_url('https://h/a b#c') AS q").head().asDict() == {"j": "https://h/b", "q": "https://h/a%20b"}
    entries = "<section><h2>S</h2><a href=\"/e/1\">One</a></section>"
    assert spark.sql(f"SELECT * FROM index_entries('{entries}', 'https://h/', '/e/')").collect()[0]["label"] == "One"
