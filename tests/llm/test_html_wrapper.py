from tessera.llm import html_extract as h


def extracted(spark, htmls):
    rows = [(i, "http://h.example/", p) for i, p in enumerate(htmls)]
    return {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def page(i, teaser, body):
    return f"<body><div class=t><article><p>{teaser} {i}</p></article></div><div class=b>{body}</div></body>"


def test_pages_with_an_article_go_through_the_wrapper(spark):
    """The layout's content lies outside the teasers' article elements."""
    body = [f"<p>first of {i} with several more words</p><p>second of {i} and its own words</p><p>third of {i}</p>" for i in range(6)]
    found = extracted(spark, [page(i, "Read", body[i]) for i in range(6)])
    assert found[2] == "first of 2 with several more words\nsecond of 2 and its own words\nthird of 2"


def test_an_article_bounds_the_part_that_the_wrapper_found(spark):
    """Its title stands beside the heavy part; copies keep their text."""
    def one(i):
        paragraphs = "".join(f"<p>words {k} of the page {i} go on here</p>" for k in range(4))
        return f"<body><div><a href=x>menu</a></div><article><h1>Title {i}</h1><div class=c>{paragraphs}</div></article></body>"

    found = extracted(spark, [one(i) for i in range(6)] + [one(0)] * 6)
    assert found[3].split("\n") == ["Title 3"] + [f"words {k} of the page 3 go on here" for k in range(4)]
    assert found[11] == found[0] and len(found[0].split("\n")) == 5


def odd_rows():
    """Hosts of several sizes, null and empty pages, repeated rows."""
    rows = [(i, f"http://h{i % 5}.example/{i}", page(i, "Read", f"<p>All rights reserved</p><p>words {i} of it go on here</p><p>more {i}</p>"))
            for i in range(40)]
    return rows + [rows[3], rows[3], (None, None, rows[4][2]), (41, rows[1][1], None), (42, None, None), (43, "x", ""), (None, rows[2][1], "<p>z")]


def test_pages_are_not_shuffled_to_choose_references(spark, monkeypatch):
    from tessera.operators import sinks

    plans, old, write = {}, spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), sinks.materialize

    def noted(df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, *rest)

    monkeypatch.setattr(sinks, "materialize", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        h.extract(spark.createDataFrame(odd_rows(), "page_id long, url string, html string"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert all("SortMergeJoin" not in plans[name] for name in ("html-references", "html-layouts"))


def test_hosts_taken_in_parts_and_joined_by_shuffle_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame(odd_rows(), "page_id long, url string, html string")
    whole = sorted(map(str, h.extract(df).collect()))
    assert len(whole) == len(odd_rows()) and any("words 7 of it" in r and "rights" not in r for r in whole)
    monkeypatch.setattr(h, "PART_HOSTS", 2)
    assert sorted(map(str, h.extract(df).collect())) == whole
    monkeypatch.setattr(h, "BROADCAST_BYTES", -1)
    assert sorted(map(str, h.extract(df).collect())) == whole
