import datetime

import pytest

from lodestrand.operators import compaction
from lodestrand.schema import FETCH
from lodestrand.sinks import cache
from lodestrand.sources import store
from tests.conftest import rows
from tests.test_crawl import items_of

T = datetime.datetime(2024, 1, 1)


def test_latest_visit(spark):
    h = datetime.timedelta(hours=1)
    data = [("u", "u", 200, {"a": "1"}, None, None, None, T, T + h), ("u", "u", 404, None, None, None, "e", T + h, T + h), ("u", "u", 404, None, None, None, "e", T + h, T + h), ("v", "v", None, {}, None, None, None, None, None), (None, "x", 1, None, None, None, None, T, T)]
    got = store.latest(spark.createDataFrame(data, FETCH))
    assert got.columns == spark.createDataFrame([], FETCH).columns and rows(got, "url", "status") == [("u", 404), ("v", None)]


def test_cache_first(spark, tmp_path):
    kept = spark.createDataFrame([("http://a.test/1", "http://a.test/1", 200, {"x": "y"}, None, "h", None, T, T)], FETCH)
    urls = spark.createDataFrame([("http://a.test/1",), ("http://a.test/2",), ("http://a.test/2",), (None,)], "url string")

    def fetcher(it):
        for u in it:
            yield (u, u, 200, {"got": "live"}, None, "new", None, None, None)

    got = store.fetch_missing(urls, kept, fetcher, str(tmp_path / "store"))
    assert rows(got, "url", "html") == [("http://a.test/1", "h"), ("http://a.test/2", "new")]
    assert spark.read.parquet(str(tmp_path / "store")).count() == 1


def test_tree_round_trip(spark, tmp_path):
    site = "http://s.test/"
    given = [
        dict(item_id=1, path="", site_url=site, html_raw="<p>root", content_info={"content-type": "text/html", "x": "100%"}),
        dict(item_id=2, path="a", site_url=site, type="Document", text="doc é", content_info={"content-type": "text/html"}),
        dict(item_id=3, path="a/b.gif", site_url=site, type="Image", image=(bytearray(b"\x00gif"), "b.gif", "image/gif")),
        dict(item_id=4, path="old", site_url=site, redir="a", type="Link"),
        dict(item_id=5, path="c/d/", site_url=site, content_bin=bytearray(b"bin")),
        dict(item_id=6, site_url=site, html_raw="no path"), dict(item_id=7, bad_url="http://x.test/"),
    ]
    items = items_of(spark, *given)
    assert rows(cache.with_files(items).filter("path IS NOT NULL"), "path", "cache_path") == [("", "index.html"), ("a", "a/.content"), ("a/b.gif", "a/b.gif"), ("c/d/", "c/d/index.html"), ("old", "old")]
    root = str(tmp_path / "tree")
    cache.export_tree(items, root)
    heads = {r["path"]: (r["content_info"], bytes(r["content"]) if r["content"] is not None else None) for r in store.headers_of(store.read_tree(spark, root)).collect()}
    assert heads["a/.content"] == ({"content-type": "text/html"}, "doc é".encode()) and heads["old"] == ({"location": "http://s.test/a"}, None)
    assert heads["index.html"][0]["x"] == "100%" and heads["a/b.gif"][0]["content-type"] == "image/gif"
    got = {r["url"]: (r["status"], r["final_url"]) for r in store.tree_fetches(spark, root, site).collect()}
    assert got[site] == (200, site) and got[site + "a/"] == (200, site + "a/") and got[site + "old"] == (302, site + "a")
    assert "c/" in {u[len(site):] for u in got}  # a directory without index has a listing


def test_climbing_paths_are_refused(spark, tmp_path):
    items = items_of(spark, dict(item_id=1, path="../../etc/x", html_raw="h"))
    with pytest.raises(Exception, match="lies outside"):
        cache.export_tree(items, str(tmp_path / "t"))


def test_append_holds_no_copies(spark, tmp_path):
    items = items_of(spark, dict(item_id=1, path="p", site_url="http://s.test", html_raw="h"))
    path = str(tmp_path / "store")
    for _ in range(2):
        assert cache.append_new(items, path) is items
    assert rows(spark.read.parquet(path), "url", "final_url", "status") == [("http://s.test/p", "http://s.test/p", 200)]


def test_listing(spark):
    paths = spark.createDataFrame([("b/x y",), ("b/c/d",), ("a",), ("",), (None,)], "path string")
    assert rows(store.listing_rows(paths)) == [("", "a", False), ("", "b", True), ("b", "c", True), ("b", "x y", False), ("b/c", "d", False)]
    html = {r["directory"]: r["html"] for r in store.listing_html(store.listing_rows(paths), "file:///r").collect()}
    assert html["b"].split("\n")[:3] == ['<BASE HREF="file:///r/b/">', '<A HREF="c/">c</A>', '<A HREF="x%20y">x y</A>']
    index = spark.createDataFrame([("d/index.htm",), ("d/index.html",), ("e/.content",), ("index_html",)], "path string")
    assert rows(store.index_of(index)) == [("", "index_html"), ("d/", "d/index.html"), ("e/", "e/.content")]


FILES = [
    '{"rec_id": 1, "_path": "a", "_type": null, "title": "t", "note": "n"}\n{"note":"x","rec_id":"2","_path":"b"}\r\n\n',
    '{"_path": "a", "rec_id": "1", "title": "t", "note": "n", "_type": null}\n{"rec_id": 3, "_path": "c',
    "", None, '{"rec_id": 4, "title": "brace } in text"}', '[{"rec_id": 5}]\n"x"\n{"no": 1}\n{"rec_id": "no number"}\n{"rec_id": 6} {"rec_id": 7}', '{"rec_id": null}', '{"rec_id": 8, "t": "cut}',
]


def files(spark):
    return spark.createDataFrame([(i, f"http://{'hot' if i % 3 else 'b'}.test", "p", b) for i, b in enumerate(FILES)], "file_id bigint, site_url string, path string, body string")


def test_whole_records(spark):
    got = compaction.distinct_records(compaction.whole_records(files(spark)))
    assert rows(got, "rec_id") == [(1,), (2,), (4,)]


def test_compaction(spark, tmp_path):
    target = str(tmp_path / "out")
    data = spark.createDataFrame([(f"s{i % 3}", i, "x" * 200) for i in range(900)], "site string, id bigint, text string").repartition(30)
    report = compaction.compact(data, target, keys=["site", "id"], target_bytes=40_000)
    assert report.rows == 900 and 3 <= report.files <= 8
    parts = [[(r["site"], r["id"]) for r in spark.read.parquet(str(p)).collect()] for p in sorted((tmp_path / "out").glob("*.parquet"))]
    assert len(parts) == report.files and all(p == sorted(p) for p in parts)
    assert [x for p in parts for x in p] == sorted((f"s{i % 3}", i) for i in range(900))
    again = compaction.compact(data.limit(0), target, keys=["site", "id"])  # replaces what was there
    assert (again.rows, spark.read.schema(data.schema).parquet(target).count()) == (0, 0)


def test_compaction_keeps_the_old_folder_when_counts_differ(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    data = spark.createDataFrame([(1,), (2,)], "id bigint")
    compaction.compact(data, target, keys=["id"])
    real = compaction.fingerprint
    calls = []
    monkeypatch.setattr(compaction, "fingerprint", lambda df: (calls.append(1), (real(df)[0] + len(calls), 0))[1])
    with pytest.raises(RuntimeError, match="left as it was"):
        compaction.compact(data.union(data), target, keys=["id"])
    assert rows(spark.read.parquet(target)) == [(1,), (2,)]


def test_compaction_of_no_files(spark, tmp_path):
    assert compaction.compact_cache(files(spark).limit(0), str(tmp_path / "o")).count() == 0
