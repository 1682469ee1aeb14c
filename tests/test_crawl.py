import pytest
from pyspark.sql import functions as F

from lodestrand.config import CrawlConfig, java_regex, java_substitute, regex_list
from lodestrand.operators import crawl, filters, pages, ranking, recognise
from lodestrand.plans import pipeline
from lodestrand.schema import FETCH, ITEM, LINK, MIME_TYPES
from tests.conftest import rows

SITE = "http://site.test/"
PAGES = {
    "": '<a href="file1.htm">One</a> <a href=/file2.htm>Two  \n words</a>',
    "file1.htm": '<html><body><a href="http://elsewhere.test/x">Away</a><a href="file2.htm#top">Two again</a><p>open',
    "file2.htm": '<a href="file2.htm">self</a><a href="/">up</a><a href=sub/one.htm>Sub</a><a href="sub2/one.htm">Sub</a><img src="p.gif" alt=" a  pic ">',
    "sub/one.htm": '<a href="../file1.htm">back</a><a href="../doc.doc">Doc</a>',
    "sub2/one.htm": '<a href="../file1.htm">back</a><a href="moved">m</a>',
}


def fetch(url, final=None, status=200, ct="text/html", body=None, html=None, error=None):
    return (url, final or url, status, {"Content-Type": ct} if ct else None, body, html, error, None, None)


@pytest.fixture(scope="module")
def fetches(spark):
    out = [fetch(SITE + p, html=h) for p, h in PAGES.items()]
    out += [fetch(SITE + "doc.doc", ct="application/msword", body=bytearray(b"doc")), fetch(SITE + "p.gif", ct="image/gif", body=bytearray(b"")), fetch(SITE + "sub2/moved", SITE + "sub/one.htm", 200, html=PAGES["sub/one.htm"])]
    return spark.createDataFrame(out, FETCH)


def test_options():
    c = CrawlConfig.of({"url": "http://a.test", "ignore": "x\n  \ny", "start-urls": "u1 u2", "max": "5", "ignore-robots": "On", "patterns": "(?P<n>a)\n\nb\nc", "subs": "\\g<n>\nx\n<EMPTYSTRING>"})
    assert (c.site_url, c.ignore, c.start_urls, c.max, c.ignore_robots, c.maxsize) == ("http://a.test/", ("x", "y"), ("u1", "u2"), 5, True, None)
    assert c.patches == (("(?P<n>a)", "\\g<n>"), ("b", ""))
    assert (java_regex("(?P<n>a)(?P=n)"), java_substitute(r"\1 $ \g<n> \g<2>")) == (r"(?<n>a)\k<n>", r"$1 \$ ${n} $2")
    assert regex_list(None) == ()
    with pytest.raises(ValueError, match="site_url"):
        CrawlConfig.of({})


def test_verdicts(spark):
    config = CrawlConfig(SITE, ignore=("(?i)SECRET", "\\.css$"), whitelist=("file", "secret"))
    df = spark.createDataFrame([(SITE + "secret/file",), (SITE + "other",), ("http://b.test/file",), (SITE + "file1",), (None,)], "url string")
    got = [tuple(r) for r in df.select(filters.verdict(F.col("url"), config), filters.first_match(F.col("url"), config.ignore)).collect()]
    assert got == [("ignored", "(?i)SECRET"), ("not whitelisted", None), ("outside", None), (None, None), (None, None)]


def test_links_in_order(spark):
    df = spark.createDataFrame([(SITE + p, i, h) for i, (p, h) in enumerate(PAGES.items())] + [(None, 9, "x"), (SITE + "n", 9, None)], "url string, seq bigint, html string")
    got = rows(pages.extract_links(df).filter(F.col("seq") == 2), "pos", "dst", "raw", "fragment", "attr", "name")
    assert [(r[1][len(SITE):], r[4], r[5]) for r in got] == [("file2.htm", "href", "self"), ("", "href", "up"), ("sub/one.htm", "href", "Sub"), ("sub2/one.htm", "href", "Sub"), ("p.gif", "src", "a pic")]
    assert rows(pages.extract_links(df).filter(F.col("seq") == 1), "dst", "fragment")[1] == (SITE + "file2.htm", "top")


def test_page_edges():
    html = '<BASE HREF="http://b.test/d/"><meta HTTP-EQUIV="Refresh" content="3; URL=Next.HTM"><meta http-equiv=refresh content=5><a href="x/">  a <b>b</b>\n</a><img src=i.png><form action="go"></form><script>var a="<a href=no>";</script>'
    got = [(x[0], x[3], x[4]) for x in pages.links_of("http://b.test/", html)]
    assert got == [("http://b.test/d/Next.HTM", "refresh", None), ("http://b.test/d/x", "href", "a b"), ("http://b.test/d/i.png", "src", ""), ("http://b.test/d/go", "action", None)]
    clean = pages.clean_html("http://b.test/", "<p>a &amp; <b>b<script>x</script><!-- c --><a href=/y/>z")
    assert clean == '<p>a &amp; <b>b<a href="http://b.test/y">z</a></b></p>'
    assert pages.links_of("http://b.test/", None) == [] and pages.clean_html("u", None) is None


@pytest.mark.parametrize(("body", "ct", "want"), [
    ("é".encode("latin-1"), "text/html; charset=iso-8859-1", "é"), (b'<meta charset="latin-1">' + "é".encode("latin-1"), None, '<meta charset="latin-1">é'),
    ("é".encode(), "text/html", "é"), (b"\x93q\x94", "text/html; charset=nonsense", "“q”"), (b"\xff", "text/html; charset=utf-8", "ÿ"), (None, None, None), (b"", None, ""),
])
def test_decoding(body, ct, want):
    assert pages.decode_page(body, ct) == want


def test_patches(spark):
    config = CrawlConfig(SITE, patches=(("(?s)<i>(?P<t>.*?)</i>", r"[\g<t>]"), ("b+", "")))
    df = spark.createDataFrame([("<i>a\nb</i>bb<i>c</i>",), (None,)], "t string")
    assert [r[0] for r in df.select(pages.patched(F.col("t"), config)).collect()] == ["[a\n][c]", None]
    assert [r[0] for r in df.select(pages.patch_counts(F.col("t"), config)).collect()][0] == [2, 2]
    df = spark.createDataFrame([("abc", ["b", "", "c"], ["<EMPTYSTRING>", "x"]), ("abc", None, ["x"])], "t string, p array<string>, s array<string>")
    assert [r[0] for r in df.select(pages.site_patched(F.col("t"), F.col("p"), F.col("s"))).collect()] == ["ac", "abc"]


def test_traversal_order_is_that_of_a_queue(spark):
    edges = [("a", 0, "b"), ("a", 1, "c"), ("b", 0, "d"), ("c", 0, "d"), ("c", 1, "a"), ("c", 2, "e"), ("d", 0, "f"), ("x", 0, "y"), ("a", 2, "x"), (None, 0, "q"), ("a", 3, None)]
    df = spark.createDataFrame(edges, "src string, pos int, dst string")
    start = spark.createDataFrame([("a", 0)], "url string, seq bigint")
    got = crawl.traverse(start, df, reject=F.when(F.col("url") == "x", "no"))
    assert [(r["url"], r["depth"], r["reason"]) for r in got.orderBy("place").collect()] == [("a", 0, None), ("b", 1, None), ("c", 1, None), ("x", 1, "no"), ("d", 2, None), ("e", 2, None), ("f", 3, None)]
    assert [r["url"] for r in crawl.traverse(start, df.repartition(7), max_pages=3).orderBy("place").collect()] == ["a", "b", "c"]
    assert crawl.traverse(start.limit(0), df).count() == 0


def test_ranks(spark):
    df = spark.createDataFrame([(k, i) for k in ("hot",) * 50 + ("b", "a", None) for i in [0]], "k string, i int").withColumn("i", F.monotonically_increasing_id())
    got = ranking.ranked(df, ["k", "i"], "r", within="k", parts=5)
    assert sorted(r["r"] for r in got.filter("k = 'hot'").collect()) == list(range(50))
    assert rows(got.filter("k <> 'hot' OR k IS NULL"), "k", "r") == [("a", 0), ("b", 0), (None, 0)]
    assert ranking.ranked(df.limit(0), ["k"], "r").count() == 0


def test_ranks_and_backlinks_of_links(spark):
    data = [("s1", 0, 0, "t", None, None, "href", "A"), ("s1", 0, 1, "t", None, None, "href", "A"), ("s2", 1, 0, "u", None, None, "action", None), ("s0", 2, 0, "t", None, None, "src", "p"), ("s0", 2, 1, None, None, None, "href", "z")]
    links = spark.createDataFrame(data, LINK)
    assert rows(crawl.sort_order(links)) == [("t", 0), ("u", 1)]
    assert rows(crawl.backlink_rows(links)) == [("t", 0, "s1", "A"), ("t", 1, "s1", "A"), ("t", 2, "s0", "p")]
    assert [(r["dst"], r["n"], [tuple(b) for b in r["backlinks"]]) for r in crawl.backlinks(links, 2).collect()] == [("t", 3, [("s1", "A"), ("s1", "A")])]


def test_robots(spark):
    rules = spark.createDataFrame([("http://a.test", "/private", False), ("http://a.test", "/private/open", True)], "origin string, prefix string, allow boolean")
    urls = spark.createDataFrame([("http://a.test/private/x",), ("http://A.test/private/open/y",), ("http://b.test/private",), ("http://a.test",)], "url string")
    assert [r["allowed"] for r in filters.robots_verdict(urls, rules).orderBy("url").collect()] == [True, True, False, True]
    assert all(r["allowed"] for r in filters.robots_verdict(urls, rules, ignore_robots=True).collect())


def test_mini_site(spark, fetches):
    ctx = pipeline.Context(spark, {"fetches": fetches})
    items = pipeline.run(ctx, [("webcrawler", {"site_url": SITE}), ("typerecognitor", {})]).cache()
    content = {r["path"]: r for r in items.filter("bad_url IS NULL AND redir IS NULL").collect()}
    assert set(content) == {"", "file1.htm", "file2.htm", "sub/one.htm", "sub2/one.htm", "doc.doc", "p.gif"}
    assert {r["bad_url"] for r in items.filter("bad_url IS NOT NULL").collect()} == {"http://elsewhere.test/x"}
    assert [(r["path"], r["redir"], r["type"], r["remote_url"]) for r in items.filter("redir IS NOT NULL").collect()] == [("sub2/moved", "sub/one.htm", "Link", "../sub/one.htm")]
    assert (content["doc.doc"]["type"], bytes(content["doc.doc"]["file"]["data"]), content["doc.doc"]["file"]["filename"]) == ("File", b"doc", "doc.doc")
    assert (content["p.gif"]["type"], content["p.gif"]["image"]["mimetype"]) == ("Image", "image/gif")
    assert "<p>open</p>" in content["file1.htm"]["text"] and content["file1.htm"]["content_text"] is None
    names = {(b["url"][len(SITE):], b["name"]) for b in content["file1.htm"]["backlinks"]}
    assert names == {("", "One"), ("sub/one.htm", "back"), ("sub2/one.htm", "back"), ("sub2/moved", "back")}
    order = sorted((r["sortorder"], p) for p, r in content.items() if p)
    assert [p for _, p in order][:2] == ["file1.htm", "file2.htm"]
    assert {r["path"] for r in pipeline.run(ctx, [("webcrawler", {"site_url": SITE, "max": "2"})]).collect()} == {"", "file1.htm"}
    # A page over the size limit is not parsed: it is bad and its links are not followed.
    assert {r["bad_url"] for r in pipeline.run(ctx, [("webcrawler", {"site_url": SITE, "maxsize": "20"})]).collect()} == {SITE}


def test_an_item_has_all_its_backlinks(spark):
    pages_ = [fetch(SITE, html="<a href=/file1.htm>x</a>" * 1100), fetch(SITE + "file1.htm", html="<p>text")]
    items = pipeline.run(pipeline.Context(spark, {"fetches": spark.createDataFrame(pages_, FETCH)}), [("webcrawler", {"site_url": SITE})])
    assert {r["path"]: len(r["backlinks"]) for r in items.collect()} == {"": 0, "file1.htm": 1100}


def test_robots_in_the_pipeline(spark, fetches):
    rules = spark.createDataFrame([("http://SITE.test", "/sub", False), ("http://site.test", "/sub2/", True), ("http://site.test", "/sub2/moved", False), ("http://other.test", "/", False)], "origin string, prefix string, allow boolean")
    ctx = pipeline.Context(spark, {"fetches": fetches, "robots": rules})
    got = pipeline.run(ctx, [("webcrawler", {"site_url": SITE})]).collect()
    assert {r["bad_url"] for r in got if r["bad_url"]} == {SITE + "sub/one.htm", SITE + "sub2/moved", "http://elsewhere.test/x"}
    assert {r["path"] for r in got if r["path"] is not None} == {"", "file1.htm", "file2.htm", "sub2/one.htm", "p.gif"}
    free = pipeline.run(ctx, [("webcrawler", {"site_url": SITE, "ignore-robots": "true"})]).collect()
    assert {r["bad_url"] for r in free if r["bad_url"]} == {"http://elsewhere.test/x"} and "doc.doc" in {r["path"] for r in free}


def test_pipeline_text(spark, fetches):
    text = f"[pipeline]\npipeline =\n    crawl\n    drop\n    type\n[crawl]\nblueprint = any.webcrawler\nsite_url = {SITE}\nignore = sub2\n[drop]\nblueprint = condition\ncondition = bad_url IS NULL\n[type]\nblueprint = x.typerecognitor\n"
    ctx = pipeline.Context(spark, {"fetches": fetches})
    assert pipeline.run_ini(ctx, text).filter("path LIKE 'sub2%'").count() == 0
    assert pipeline.run_ini(ctx, text, "[pipeline]\npipeline -= drop type\n").filter("bad_url IS NOT NULL").count() == 2
    assert pipeline.run(ctx, [("webcrawler", {})]) is None
    with pytest.raises(KeyError, match="nothing"):
        pipeline.run(ctx, [("nothing", {})])


def item(**kw):
    names = [c.split()[0] for c in ITEM.replace(">>", "").split(", ") if " " in c]
    return kw, names


def items_of(spark, *given):
    schema = spark.createDataFrame([], ITEM).schema
    return spark.createDataFrame([tuple(g.get(n) for n in schema.names) for g in given], schema)


def test_recognition(spark):
    given = [dict(item_id=i, path="a/f.bin", content_bin=bytearray(b"x"), content_info={"Content-Type": f"{m.upper()} ; charset=x"}) for i, m in enumerate(MIME_TYPES)]
    given += [
        dict(item_id=100, bad_url="u"), dict(item_id=101, path="p", type="Page", content_text="t"), dict(item_id=102, path="a/b", redir="a/c"), dict(item_id=103, content_text="no path"),
        dict(item_id=104, path="x.HTML", content_text="", content_info=None), dict(item_id=105, path="x", content_text="t", content_info={}), dict(item_id=106, path="y.png", content_text="t", content_info={"content-type": "application/xhtml+xml"}),
    ]
    df = items_of(spark, *given).withColumn("extra", F.lit(1))
    got = {r["item_id"]: r for r in recognise.recognise(df).collect()}
    assert [got[i]["type"] for i in range(17)] == list(MIME_TYPES.values()) and [got[i]["mimetype"] for i in range(17)] == list(MIME_TYPES)
    assert (got[100]["type"], got[101]["type"], got[101]["content_text"], got[103]["type"], got[103]["content_text"]) == (None, "Page", "t", None, "no path")
    assert (got[102]["type"], got[102]["remote_url"]) == ("Link", "c")
    assert (got[104]["type"], got[104]["text"], got[105]["type"], got[105]["mimetype"], got[106]["type"]) == ("Document", "", "File", None, "File")
    assert rows(recognise.summary(df).filter("type = 'Link'")) == [("Link", "", 1)]
    assert recognise.recognise(df.limit(0)).count() == 0


def test_streaming(spark, tmp_path):
    from lodestrand.streaming.recognise import run_once

    src, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    items_of(spark, dict(item_id=1, path="a.html", content_text="t")).write.parquet(src)
    run_once(spark, src, out, mark)
    items_of(spark, dict(item_id=2, path="a.png", content_bin=bytearray(b"t"))).write.mode("append").parquet(src)
    run_once(spark, src, out, mark)
    assert rows(spark.read.parquet(out), "item_id", "type") == [(1, "Document"), (2, "Image")]
