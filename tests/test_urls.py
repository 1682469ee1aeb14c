from urllib.parse import unquote_plus

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrand.functions import urls as U
from tests.conftest import rows

RELATIVE = [
    ("http://foo/a/b", "http://foo/c", "../c"), ("a/b/c", "a/d", "../d"), ("x", "x", "x"), ("http://foo/a/", "http://foo/a", "../a"),
    ("http://foo/a", "http://bar/a", "http://bar/a"), ("a/b", "a", ""), ("a", "b?q=1#f", "b?q=1#f"),
]


def one(spark, expr, **values):
    cols = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], cols).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("source", "target", "want"), RELATIVE)
def test_relative_url(spark, source, target, want):
    assert one(spark, U.relative_url("s", "t"), s=source, t=target) == want


PATHS = [
    ("http://a.test/x//y/", "http://a.test/", "x/y"), ("http://a.test/%2Fq+r", "http://a.test", "/q r"), ("http://a.test/b%zzc", "http://a.test/", "b%zzc"),
    ("http://a.test/b?x=1", "http://a.test/", "b?x=1"), ("http://a.test", "http://a.test/", ""), ("http://a.test/%e4%bd%a0", "http://a.test/", "你"),
]


@pytest.mark.parametrize(("url", "site", "want"), PATHS)
def test_site_path(spark, url, site, want):
    assert one(spark, U.site_path("u", "s"), u=url, s=site) == want


def test_prefix_has_no_boundary_unless_strict(spark):
    df = spark.createDataFrame([("http://a.com",), ("http://a.com/x",), ("http://a.com.evil/x",), (None,)], "u string")
    got = [tuple(r) for r in df.select(U.in_site("u", F.lit("http://a.com/")), U.in_site("u", F.lit("http://a.com/"), strict=True)).collect()]
    assert got == [(True, True), (True, True), (True, False), (None, None)]


def test_fragment_slash_and_post(spark):
    df = spark.createDataFrame([("/a/#b#c",), ("/a",), (None,)], "u string")
    assert [tuple(r) for r in df.select(U.strip_fragment("u"), U.fragment("u"), U.strip_slash(U.strip_fragment("u"))).collect()] == [("/a/", "b#c", "/a"), ("/a", None, "/a"), (None, None, None)]
    df = spark.createDataFrame([("/f?a=1?b",), ("/f",)], "u string")
    assert [tuple(r) for r in df.select(U.post_url("u"), U.post_body("u"), U.cache_key("u", F.lit(True))).collect()] == [("/f", "a=1?b", "/f?a=1?b"), ("/f", None, "/f")]


def test_headers_in_any_case(spark):
    df = spark.createDataFrame([({"CONTENT-Type": "Text/HTML; Charset='utf-8'"},), ({},), (None,)], "h map<string,string>")
    got = df.select(U.media_type(U.header("h", "content-type")), U.charset(U.header("h", "content-type"))).collect()
    assert [tuple(r) for r in got] == [("text/html", "utf-8"), ("", ""), ("", "")]


def test_files(spark):
    df = spark.createDataFrame([("a/b.tar.gz",), ("a/",), ("",), ("c",)], "p string")
    got = [tuple(r) for r in df.select(U.cache_file("p"), U.filename("p"), U.extension("p"), U.guess_mime("p")).collect()]
    assert got == [("a/b.tar.gz", "b.tar.gz", "gz", None), ("a/index.html", "", "a/", None), ("index.html", "", "", None), ("c", "c", "c", None)]
    assert one(spark, U.quote("p"), p="a b/ü~") == "a%20b/%C3%BC~"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab/%+2Fz", max_size=12), min_size=1, max_size=20))
def test_path_properties(spark, paths):
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for r in df.select("p", U.collapse_slashes("p").alias("c"), U.collapse_slashes(U.collapse_slashes("p")).alias("cc"), U.unquote_plus("p").alias("u")).collect():
        assert r["c"] == r["cc"] and "//" not in r["c"] and not r["c"].startswith("/") and not r["c"].endswith("/")
        assert r["u"] == unquote_plus(r["p"])


def test_no_rows(spark):
    df = spark.createDataFrame([], "u string, s string")
    assert rows(df.select(U.site_path("u", "s"), U.relative_url("u", "s"))) == []
