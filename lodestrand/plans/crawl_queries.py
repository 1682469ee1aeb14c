"""Queries of the crawl operators over the test tables, each with the same in DuckDB's SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrand.functions import urls as U
from lodestrand.operators import crawl, filters, pages, ranking, recognise
from lodestrand.schema import EXTENSIONS, HTML_TYPES
from lodestrand.session import table
from lodestrand.sinks import cache
from lodestrand.sources import store

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# DuckDB spellings that several queries share.
SITE = "CASE WHEN site_url LIKE '%/' THEN left(site_url, length(site_url) - 1) ELSE site_url END"
ORIGIN = "lower(regexp_extract({0}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1))"
HEADER = "list_filter(map_entries(content_info), lambda e: lower(e.key) = '{0}')[1].value"
COLLAPSE = "array_to_string(list_filter(string_split({0}, '/'), lambda x: x <> ''), '/')"
UNQUOTE = "url_decode(replace(regexp_replace({0}, '%($|[^0-9A-Fa-f]|[0-9A-Fa-f]($|[^0-9A-Fa-f]))', '%25\\1', 'g'), '+', ' '))"
SITES = f"""sites AS (
    SELECT *, {ORIGIN.format('site_url')} AS o FROM crawl_configs WHERE site_url IS NOT NULL
), asked AS (
    SELECT url, arg_min(s, (CASE WHEN starts_with(url, regexp_replace(s.site_url, '/$', '')) THEN 0 ELSE 1 END, -length(s.site_url), s.site_url)) AS c
    FROM (SELECT DISTINCT dst AS url FROM links WHERE dst IS NOT NULL) u JOIN sites s ON s.o = {ORIGIN.format('url')} GROUP BY url
)"""
MIME = "CASE " + " ".join(f"WHEN ext = '{k}' THEN '{v}'" for k, v in EXTENSIONS.items()) + " END"
GUESS = f"(SELECT {MIME} FROM (SELECT lower(regexp_extract(string_split(regexp_replace(path, '[?#].*$', ''), '/')[-1], '\\.([A-Za-z0-9]+)$', 1)) AS ext))"


def _asked(spark, d):
    """Distinct link targets, each with the crawl of its host."""
    targets = table(spark, d, "links").filter("dst IS NOT NULL").select(F.col("dst").alias("url")).distinct()
    return filters.with_config(targets, table(spark, d, "crawl_configs"))


_IGNORE = "list_concat(coalesce(c.ignore, []), ['/(help|archive)'])"


@query(f"WITH {SITES} SELECT url, c.site_url AS site_url, list_filter({_IGNORE}, lambda p: regexp_matches(url, p))[1] AS pattern FROM asked WHERE len(list_filter({_IGNORE}, lambda p: regexp_matches(url, p))) > 0")
def crawl_ignore_filter(spark, d):
    """By the crawls' own patterns, of which few meet a link of these tables, and one more."""
    patterns = F.concat(F.coalesce("config.ignore", F.array().cast("array<string>")), F.array(F.lit("/(help|archive)")))
    hit = F.filter(patterns, lambda p: F.regexp_like(F.col("url"), p))
    return _asked(spark, d).select("url", F.col("config.site_url").alias("site_url"), F.get(hit, F.lit(0)).alias("pattern")).filter("pattern IS NOT NULL")


@query(f"WITH {SITES} SELECT url, c.site_url AS site_url FROM asked WHERE len(c.whitelist) > 0 AND len(list_filter(c.whitelist, lambda p: regexp_matches(url, p))) = 0")
def crawl_whitelist_filter(spark, d):
    rows = _asked(spark, d).filter("size(config.whitelist) > 0")
    return rows.filter(~F.exists("config.whitelist", lambda p: F.regexp_like(F.col("url"), p))).select("url", F.col("config.site_url").alias("site_url"))


@query(f"WITH {SITES} SELECT url, starts_with(url, regexp_replace(c.site_url, '/$', '')) AS inside FROM asked")
def crawl_site_prefix(spark, d):
    return _asked(spark, d).select("url", U.in_site("url", F.col("config.site_url")).alias("inside"))


_VERDICT = """CASE WHEN len(list_filter(coalesce(c.ignore, []), lambda p: regexp_matches(url, p))) > 0 THEN 'ignored'
    WHEN len(coalesce(c.whitelist, [])) > 0 AND len(list_filter(c.whitelist, lambda p: regexp_matches(url, p))) = 0 THEN 'not whitelisted'
    WHEN NOT starts_with(url, regexp_replace(c.site_url, '/$', '')) THEN 'outside' END"""


@query(f"WITH {SITES} SELECT c.site_url AS site_url, coalesce({_VERDICT}, 'fetch') AS verdict, count(*) AS n FROM asked GROUP BY ALL")
def crawl_verdicts(spark, d):
    c = F.col("config")
    v = F.coalesce(filters.site_verdict(F.col("url"), c["site_url"], c["ignore"], c["whitelist"]), F.lit("fetch"))
    return _asked(spark, d).select(c["site_url"].alias("site_url"), v.alias("verdict")).groupBy("site_url", "verdict").agg(F.count("*").alias("n"))


_LATEST = """latest AS (
    SELECT url, arg_max(f, (coalesce(fetched_at, TIMESTAMP '1900-01-01'), coalesce(loaded_at, TIMESTAMP '1900-01-01'))) AS f
    FROM (SELECT * FROM fetches WHERE url IS NOT NULL) f GROUP BY url
)"""


@query(f"WITH {_LATEST} SELECT url, f.fetched_at AS fetched_at, f.loaded_at AS loaded_at FROM latest")
def fetch_latest(spark, d):
    return store.latest(table(spark, d, "fetches")).select("url", "fetched_at", "loaded_at")


@query("SELECT url AS bad_url, count(*) AS n FROM fetches WHERE error IS NOT NULL OR status >= 400 OR content_info IS NULL OR cardinality(content_info) = 0 GROUP BY url")
def crawl_bad_urls(spark, d):
    bad = F.col("error").isNotNull() | (F.col("status") >= 400) | F.col("content_info").isNull() | (F.size("content_info") == 0)
    return table(spark, d, "fetches").filter(bad).groupBy(F.col("url").alias("bad_url")).agg(F.count("*").alias("n"))


@query(f"""SELECT item_id, length(html_raw) AS n_chars FROM items i JOIN (SELECT lower({SITE}) AS s, max(maxsize) AS maxsize FROM crawl_configs GROUP BY 1) c
    ON lower(CASE WHEN i.site_url LIKE '%/' THEN left(i.site_url, length(i.site_url) - 1) ELSE i.site_url END) = c.s WHERE html_raw IS NOT NULL AND (maxsize IS NULL OR length(html_raw) <= maxsize)""")
def crawl_maxsize(spark, d):
    """Pages within the size limit of their crawl."""
    limits = table(spark, d, "crawl_configs").groupBy(U.site_name("site_url").alias("s")).agg(F.max("maxsize").alias("maxsize"))
    rows = table(spark, d, "items").filter("html_raw IS NOT NULL").withColumn("s", U.site_name("site_url")).join(limits, "s")
    return rows.filter(filters.within_size(F.col("html_raw"), F.col("maxsize"))).select("item_id", F.length("html_raw").cast("bigint").alias("n_chars"))


@query(f"""SELECT item_id FROM (SELECT item_id, row_number() OVER (PARTITION BY lower({SITE}) ORDER BY sortorder, item_id) AS r, lower({SITE}) AS s FROM items WHERE site_url IS NOT NULL) i
    JOIN (SELECT lower({SITE}) AS s, min(max) AS max FROM crawl_configs GROUP BY 1) c USING (s) WHERE max IS NULL OR r <= max""")
def crawl_max_pages(spark, d):
    """The first items of each site in crawl order, as far as the page limit of its crawl reaches."""
    rows = table(spark, d, "items").filter("site_url IS NOT NULL").select("item_id", U.site_name("site_url").alias("s"), "sortorder")
    placed = ranking.ranked(rows, ["s", "sortorder", "item_id"], "place", within="s")
    limits = table(spark, d, "crawl_configs").groupBy(U.site_name("site_url").alias("s")).agg(F.min("max").alias("max"))
    return placed.join(limits, "s").filter("max IS NULL OR place < max").select("item_id")


@query(f"WITH {SITES}, p AS (SELECT url, substr(url, length(regexp_replace(c.site_url, '/$', '')) + 1) AS rest FROM asked WHERE starts_with(url, regexp_replace(c.site_url, '/$', ''))) SELECT url, {UNQUOTE.format(COLLAPSE.format('rest'))} AS path FROM p")
def url_site_path(spark, d):
    rows = _asked(spark, d).filter(U.in_site("url", F.col("config.site_url")))
    return rows.select("url", U.site_path("url", F.col("config.site_url")).alias("path"))


@query(f"SELECT DISTINCT path, {UNQUOTE.format('path')} AS plain FROM items WHERE path IS NOT NULL")
def url_unquote_path(spark, d):
    return table(spark, d, "items").filter("path IS NOT NULL").select("path", U.unquote_plus("path").alias("plain")).distinct()


@query("SELECT raw, regexp_replace(raw, '#.*$', '') AS base, CASE WHEN contains(raw, '#') THEN regexp_replace(raw, '^[^#]*#', '') END AS fragment, regexp_replace(regexp_replace(raw, '#.*$', ''), '/$', '') AS link, count(*) AS n FROM links GROUP BY raw")
def url_strip_fragment(spark, d):
    rows = table(spark, d, "links").groupBy("raw").agg(F.count("*").alias("n"))
    return rows.select("raw", U.strip_fragment("raw").alias("base"), U.fragment("raw").alias("fragment"), U.strip_slash(U.strip_fragment("raw")).alias("link"), "n")


@query("SELECT DISTINCT url, regexp_replace(url, '\\?.*$', '') AS action, CASE WHEN contains(url, '?') THEN regexp_replace(url, '^[^?]*\\?', '') END AS body, url AS kept_as FROM fetches")
def url_post_split(spark, d):
    rows = table(spark, d, "fetches").select("url").distinct()
    return rows.select("url", U.post_url("url").alias("action"), U.post_body("url").alias("body"), U.cache_key("url", F.lit(True)).alias("kept_as"))


_PATCH = f"""SELECT item_id, html_raw, patterns, subs FROM items i JOIN (SELECT lower({SITE}) AS s, any_value(patterns) AS patterns, any_value(subs) AS subs FROM crawl_configs GROUP BY 1) c
    ON lower(CASE WHEN i.site_url LIKE '%/' THEN left(i.site_url, length(i.site_url) - 1) ELSE i.site_url END) = c.s WHERE html_raw IS NOT NULL"""
_PAIR = "len(patterns) > 0 AND len(subs) > 0 AND patterns[1] <> '' AND subs[1] <> ''"
_SUB = "CASE WHEN subs[1] = '<EMPTYSTRING>' THEN '' ELSE subs[1] END"


def _patch_rows(spark, d):
    c = table(spark, d, "crawl_configs").groupBy(U.site_name("site_url").alias("s")).agg(F.any_value("patterns").alias("patterns"), F.any_value("subs").alias("subs"))
    return table(spark, d, "items").filter("html_raw IS NOT NULL").withColumn("s", U.site_name("site_url")).join(c, "s")


@query(f"SELECT item_id, md5(CASE WHEN {_PAIR} THEN regexp_replace(html_raw, patterns[1], {_SUB}, 'g') ELSE html_raw END) AS digest FROM ({_PATCH})")
def page_patch_regex(spark, d):
    return _patch_rows(spark, d).select("item_id", F.md5(pages.site_patched(F.col("html_raw"), F.col("patterns"), F.col("subs"))).alias("digest"))


@query("SELECT item_id, len(regexp_extract_all(html_raw, '(?s)<script.*?</script>')) AS n FROM items WHERE html_raw IS NOT NULL")
def page_patch_counts(spark, d):
    from lodestrand.config import CrawlConfig

    config = CrawlConfig("http://any.test/", patches=(("(?s)<script.*?</script>", ""),))
    return table(spark, d, "items").filter("html_raw IS NOT NULL").select("item_id", pages.patch_counts(F.col("html_raw"), config)[0].cast("bigint").alias("n"))


@query()
def link_extract(spark, d):
    """Links by the parser, of every page's raw HTML."""
    rows = table(spark, d, "items").filter("html_raw IS NOT NULL AND path IS NOT NULL")
    url = F.concat(U.site_root("site_url"), F.lit("/"), F.col("path"))
    return pages.extract_links(rows.select(url.alias("url"), F.col("item_id").alias("seq"), F.col("html_raw").alias("html")))


@query("SELECT item_id, len(regexp_extract_all(html_raw, '(?is)<a\\b[^>]*\\bhref\\s*=\\s*[\"''][^\"'']*[\"'']')) AS n FROM items WHERE html_raw IS NOT NULL")
def link_count_regex(spark, d):
    n = F.regexp_count("html_raw", F.lit(r"""(?is)<a\b[^>]*\bhref\s*=\s*["'][^"']*["']"""))
    return table(spark, d, "items").filter("html_raw IS NOT NULL").select("item_id", n.cast("bigint").alias("n"))


@query("SELECT name, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS text, count(*) AS n FROM links GROUP BY name")
def link_anchor_text(spark, d):
    return table(spark, d, "links").groupBy("name").agg(F.count("*").alias("n")).select("name", U.squash("name").alias("text"), "n")


_FIRST = "SELECT dst, min((seq, pos)) AS m FROM links WHERE dst IS NOT NULL AND attr IS DISTINCT FROM 'refresh' GROUP BY dst"


@query(f"SELECT dst, row_number() OVER (ORDER BY m, dst) - 1 AS sortorder FROM ({_FIRST})")
def link_sortorder(spark, d):
    return crawl.sort_order(table(spark, d, "links"))


@query("SELECT dst, row_number() OVER (PARTITION BY dst ORDER BY seq, pos, src, name NULLS FIRST) - 1 AS place, src AS url, name FROM links WHERE dst IS NOT NULL AND attr IN ('href', 'src')")
def link_backlinks(spark, d):
    return crawl.backlink_rows(table(spark, d, "links"))


@query("SELECT dst, count(*) AS n FROM links WHERE dst IS NOT NULL AND attr IN ('href', 'src') GROUP BY dst")
def link_backlink_count(spark, d):
    return crawl.backlink_counts(table(spark, d, "links"))


@query(f"""WITH f AS ({_FIRST}), o AS (SELECT dst, row_number() OVER (ORDER BY m, dst) - 1 AS sortorder FROM f), n AS (SELECT dst, count(*) AS n FROM links WHERE attr IN ('href', 'src') GROUP BY dst)
    SELECT dst, sortorder, coalesce(n, 0) AS n FROM o LEFT JOIN n USING (dst) WHERE regexp_matches(dst, '/(about|archive|help)')""")
def whitelisted_links(spark, d):
    """Of the targets that match a whitelist: first-encounter order and number of backlinks."""
    links = table(spark, d, "links")
    order = crawl.sort_order(links).filter(filters.matches_any(F.col("dst"), ("/(about|archive|help)",)))
    return order.join(crawl.backlink_counts(links), "dst", "left").select("dst", "sortorder", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query("SELECT item_id, site_url || regexp_extract(path, '^[^\\s]+') AS target FROM items WHERE html_raw IS NOT NULL AND site_url IS NOT NULL AND path IS NOT NULL AND regexp_matches(site_url || path, '^[^\"''>]+$') AND regexp_matches(path, '^[^\\s]')")
def meta_refresh(spark, d):
    """Pages of these tables have no refresh: each gets one, to its own address."""
    rows = table(spark, d, "items").filter("html_raw IS NOT NULL AND site_url IS NOT NULL AND path IS NOT NULL").withColumn("to", F.concat("site_url", "path"))
    rows = rows.filter(F.rlike("to", F.lit("^[^\"'>]+$")) & F.rlike("path", F.lit(r"^\S")))
    page = F.concat(F.lit('<META Http-Equiv="Refresh" content="5; URL='), F.col("to"), F.lit('">\n'), F.col("html_raw"))
    return rows.select("item_id", pages.meta_refresh(page).alias("target"))


@query(f"SELECT coalesce({HEADER.format('content-type')}, '') AS content_type, lower(trim(string_split(coalesce({HEADER.format('content-type')}, ''), ';')[1])) AS mimetype, lower(regexp_extract(coalesce({HEADER.format('content-type')}, ''), '(?i)charset\\s*=\\s*[\"'']?([^\\s;\"'']+)', 1)) AS charset, count(*) AS n FROM fetches GROUP BY 1, 2, 3")
def charset_extract(spark, d):
    rows = table(spark, d, "fetches").groupBy(U.header("content_info", "content-type").alias("content_type")).agg(F.count("*").alias("n"))
    return rows.select("content_type", U.media_type("content_type").alias("mimetype"), U.charset("content_type").alias("charset"), "n")


_TYPED = f"""t AS (
    SELECT i.*, {HEADER.format('content-type')} AS ct, bad_url IS NULL AND type IS NULL AND redir IS NULL AND path IS NOT NULL AND (content_text IS NOT NULL OR content_bin IS NOT NULL) AS typed,
        bad_url IS NULL AND type IS NULL AND redir IS NOT NULL AS link FROM items i
), m AS (SELECT *, CASE WHEN typed THEN CASE WHEN ct IS NOT NULL THEN lower(trim(string_split(ct, ';')[1])) ELSE {GUESS} END ELSE mimetype END AS mime FROM t
), k AS (SELECT m.*, CASE WHEN link THEN 'Link' WHEN typed THEN coalesce(y.type, 'File') ELSE m.type END AS kind FROM m LEFT JOIN mime_types y ON y.mimetype = m.mime)"""


@query(f"WITH {_TYPED} SELECT item_id, kind AS type, mime AS mimetype FROM k")
def type_recognise(spark, d):
    return recognise.recognise(table(spark, d, "items"), route=False).select("item_id", "type", "mimetype")


@query(f"WITH {_TYPED} SELECT kind AS type, CASE WHEN kind = 'Link' THEN '' ELSE coalesce(mime, '') END AS mimetype, count(*) AS n FROM k WHERE typed OR link GROUP BY 1, 2")
def type_summary(spark, d):
    return recognise.summary(table(spark, d, "items"))


@query(f"""WITH {_TYPED} SELECT item_id, CASE WHEN typed AND kind = 'File' THEN string_split(path, '/')[-1] ELSE file.filename END AS file_name,
    CASE WHEN typed AND kind = 'Image' THEN string_split(path, '/')[-1] ELSE image.filename END AS image_name,
    length(CASE WHEN typed AND kind = 'Document' THEN coalesce(content_text, decode(content_bin)) ELSE text END) AS text_chars, NOT typed AND content_text IS NOT NULL AS has_content FROM k""")
def type_route_fields(spark, d):
    out = recognise.recognise(table(spark, d, "items"))
    return out.select("item_id", F.col("file.filename").alias("file_name"), F.col("image.filename").alias("image_name"), F.length("text").cast("bigint").alias("text_chars"), F.col("content_text").isNotNull().alias("has_content"))


@query("SELECT url, final_url, count(*) AS n FROM fetches WHERE url <> final_url GROUP BY ALL")
def redirect_items(spark, d):
    f = table(spark, d, "fetches")
    return crawl.redirects(f).join(f.groupBy("url", "final_url").agg(F.count("*").alias("n")), ["url", "final_url"])


@query("SELECT item_id, remote_url FROM items WHERE redir IS NOT NULL AND type = 'Link'")
def relative_url(spark, d):
    """Targets as seen from their sources, against those that the table was made with."""
    rows = table(spark, d, "items").filter("redir IS NOT NULL AND type = 'Link'")
    return rows.select("item_id", U.relative_url("path", "redir").alias("remote_url"))


@query("SELECT item_id, CASE WHEN path = '' OR path LIKE '%/' THEN path || 'index.html' ELSE path END AS file, string_split(path, '/')[-1] AS name, string_split(path, '.')[-1] AS extension FROM items WHERE path IS NOT NULL")
def cache_filename(spark, d):
    rows = table(spark, d, "items").filter("path IS NOT NULL")
    return rows.select("item_id", U.cache_file("path").alias("file"), U.filename("path").alias("name"), U.extension("path").alias("extension"))


@query("""WITH i AS (SELECT path FROM items UNION SELECT string_split(path, '/')[1] FROM items WHERE path LIKE '%/%'),
    p AS (SELECT DISTINCT path, string_split(path, '/') AS s FROM i WHERE path IS NOT NULL AND path <> ''),
    u AS (SELECT DISTINCT array_to_string(s[1:i], '/') AS dir FROM (SELECT s, unnest(range(1, len(s))) AS i FROM p))
    SELECT DISTINCT path, path || '/.content' AS file FROM p WHERE path IN (SELECT dir FROM u)""")
def cache_dir_collision(spark, d):
    """Paths that are directories of other paths, and where they are kept. The first directory of each path is a page too."""
    items = table(spark, d, "items")
    upper = items.filter(F.contains("path", F.lit("/"))).withColumn("path", F.split_part("path", F.lit("/"), F.lit(1)))
    rows = cache.with_files(items.unionByName(upper)).filter(F.endswith("cache_path", F.lit("/.content")))
    return rows.select("path", F.col("cache_path").alias("file")).distinct()


@query("SELECT dst AS url, max(CASE WHEN f.url IS NULL THEN 0 ELSE 1 END) AS hit FROM (SELECT DISTINCT dst FROM links WHERE dst IS NOT NULL) l LEFT JOIN (SELECT DISTINCT url FROM fetches) f ON f.url = l.dst GROUP BY dst")
def cache_lookup_join(spark, d):
    hits, misses = store.look_up(table(spark, d, "links").select(F.col("dst").alias("url")), table(spark, d, "fetches"))
    return hits.select("url", F.lit(1).alias("hit")).unionByName(misses.select("url", F.lit(0).alias("hit")))


@query("""WITH i AS (SELECT path FROM items UNION ALL SELECT regexp_replace(path, '[^/]*$', '') || CASE WHEN content_text IS NULL THEN 'index.htm' WHEN html_raw IS NULL THEN '.content' ELSE 'index_html' END FROM items)
    SELECT regexp_replace(path, '[^/]*$', '') AS directory, arg_min(path, (list_position(['.content', 'index.html', 'index.htm', 'index_html'], string_split(path, '/')[-1]), path)) AS path
    FROM i WHERE string_split(path, '/')[-1] IN ('.content', 'index.html', 'index.htm', 'index_html') GROUP BY 1""")
def cache_index_resolution(spark, d):
    """The directories of all items, with index files of three kinds beside them."""
    items = table(spark, d, "items")
    name = F.when(F.col("content_text").isNull(), "index.htm").when(F.col("html_raw").isNull(), ".content").otherwise("index_html")
    return store.index_of(items.select("path").unionByName(items.select(F.concat(F.regexp_replace("path", "[^/]*$", ""), name).alias("path"))))


@query("SELECT url, list_filter(['/about', '(?i)ARCHIVE', '\\.(asp|html?)$'], lambda p: regexp_matches(url, p))[1] AS pattern FROM (SELECT DISTINCT dst AS url FROM links WHERE dst IS NOT NULL)")
def crawl_match_first(spark, d):
    """Of some patterns the first that each link target matches."""
    urls = table(spark, d, "links").filter("dst IS NOT NULL").select(F.col("dst").alias("url")).distinct()
    return urls.select("url", filters.first_match(F.col("url"), ("/about", "(?i)ARCHIVE", r"\.(asp|html?)$")).alias("pattern"))


@query(f"""WITH o AS (SELECT DISTINCT {ORIGIN.format('site_url')} AS o FROM crawl_configs WHERE NOT coalesce(ignore_robots, false) AND site_url IS NOT NULL),
    u AS (SELECT DISTINCT dst AS url, {ORIGIN.format('dst')} AS o, regexp_replace(dst, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', '') AS p FROM links WHERE dst IS NOT NULL)
    SELECT url, o.o IS NULL OR starts_with(p, '/archive/2023') OR NOT (starts_with(p, '/archive') OR starts_with(p, '/help')) AS allowed FROM u LEFT JOIN o ON o.o = u.o""")
def robots_gate(spark, d):
    """Link targets under the rules of the hosts whose crawls heed them: no archive but that of 2023, and no help."""
    hosts = table(spark, d, "crawl_configs").filter("site_url IS NOT NULL AND NOT coalesce(ignore_robots, false)").select(U.origin("site_url").alias("origin")).distinct()
    rules = hosts.select("origin", F.explode(F.array(*(F.struct(F.lit(p).alias("prefix"), F.lit(a).alias("allow")) for p, a in (("/archive", False), ("/archive/2023", True), ("/help", False))))).alias("r")).select("origin", "r.*")
    urls = table(spark, d, "links").filter("dst IS NOT NULL").select(F.col("dst").alias("url")).distinct()
    return filters.robots_verdict(urls, rules).select("url", "allowed")


@query("""WITH c AS (SELECT site_url, regexp_replace(site_url, '/$', '') AS root, coalesce(start_urls, []) AS u FROM crawl_configs WHERE site_url IS NOT NULL),
    f AS (SELECT site_url, root, list_filter(list_distinct(u), lambda x: x IS NOT NULL AND regexp_replace(x, '/+$', '') <> root) AS s, u FROM c),
    g AS (SELECT site_url, list_append(list_sort(s, 'ASC'), root || '/') AS l FROM f) SELECT site_url, unnest(l) AS url FROM g""")
def crawl_seeds(spark, d):
    """The start URLs of every crawl and its root."""
    return crawl.seeds_of(table(spark, d, "crawl_configs")).select("site_url", "url")


@query("SELECT item_id, coalesce(cardinality(content_info) > 0 AND (coalesce(length(content_text) > 0, false) OR content_bin IS NOT NULL), false) AS emits FROM items")
def emit_condition(spark, d):
    return table(spark, d, "items").select("item_id", filters.can_emit(F.col("content_info"), F.col("content_text"), F.col("content_bin")).alias("emits"))


@query(f"SELECT url, count(*) AS n, count_if(coalesce(lower(trim(string_split(coalesce({HEADER.format('content-type')}, ''), ';')[1])) IN ({', '.join(repr(t) for t in HTML_TYPES)}), false)) AS html FROM fetches GROUP BY url")
def html_responses(spark, d):
    html = filters.is_html(U.media_type(U.header("content_info", "content-type")))
    return table(spark, d, "fetches").groupBy("url").agg(F.count("*").alias("n"), F.count_if(html).alias("html"))


@query("SELECT item_id, trim(regexp_replace(regexp_extract(html_raw, '(?is)<title\\b[^>]*>(.*?)</title', 1), '\\s+', ' ', 'g')) AS title FROM items WHERE html_raw IS NOT NULL")
def page_title_text(spark, d):
    return table(spark, d, "items").filter("html_raw IS NOT NULL").select("item_id", pages.title(F.col("html_raw")).alias("title"))


@query("SELECT item_id, site_url || redir AS location FROM items WHERE redir IS NOT NULL")
def cache_redirects(spark, d):
    """The header that is kept of a redirect."""
    rows = table(spark, d, "items").filter("redir IS NOT NULL")
    return rows.select("item_id", F.element_at(cache.headers_to_keep(), "location").alias("location"))


@query("""SELECT item_id, CASE WHEN redir IS NOT NULL THEN NULL WHEN type = 'Document' THEN octet_length(encode(text)) WHEN type = 'File' THEN octet_length(file.data) WHEN type = 'Image' THEN octet_length(image.data)
    WHEN type IN ('Folder', 'ContentFolder') THEN NULL ELSE coalesce(octet_length(encode(html_raw)), octet_length(encode(content_text)), octet_length(content_bin)) END AS bytes FROM items""")
def cache_content(spark, d):
    """The size of what is kept of each item, by its type."""
    return table(spark, d, "items").select("item_id", F.octet_length(cache.routed_content()).cast("bigint").alias("bytes"))


@query("SELECT DISTINCT path, replace(url_encode(path), '%2F', '/') AS quoted FROM items WHERE path IS NOT NULL AND NOT contains(path, '*')")
def url_quote(spark, d):
    return table(spark, d, "items").filter("path IS NOT NULL AND NOT contains(path, '*')").select("path", U.quote("path").alias("quoted")).distinct()


@query("""WITH p AS (SELECT DISTINCT string_split(path, '/') AS s FROM cache_files WHERE path IS NOT NULL AND path <> ''), e AS (SELECT s, unnest(range(1, len(s) + 1)) AS i FROM p)
    SELECT array_to_string(s[1:i - 1], '/') AS directory, s[i] AS name, max(i < len(s)) AS is_directory FROM e WHERE s[i] <> '' GROUP BY 1, 2""")
def dir_listing(spark, d):
    return store.listing_rows(table(spark, d, "cache_files").select("path"))


@query("SELECT 'items' AS origin, path AS path, NULL::BIGINT AS length FROM items UNION ALL SELECT 'files', path, length FROM cache_files")
def upstream_union(spark, d):
    one = table(spark, d, "items").select(F.lit("items").alias("origin"), "path")
    two = table(spark, d, "cache_files").select(F.lit("files").alias("origin"), "path", "length")
    return crawl.union_upstream(one, two)


@query("SELECT item_id FROM items WHERE NOT (coalesce(mimetype IN ('image/jpeg', 'image/png'), false) OR coalesce(string_split(path, '.')[-1] IN ('pdf', 'asp'), false))")
def drop_condition(spark, d):
    return filters.drop_types(table(spark, d, "items"), ("image/jpeg", "image/png"), ("pdf", "asp")).select("item_id")


@query(f"""WITH RECURSIVE r(url) AS (SELECT regexp_replace(site_url, '/$', '') FROM crawl_configs WHERE site_url IS NOT NULL UNION SELECT l.dst FROM r JOIN (
    SELECT DISTINCT regexp_replace(src, '/$', '') AS src, dst FROM links WHERE {ORIGIN.format('src')} = {ORIGIN.format('dst')}) l ON l.src = r.url) SELECT url FROM r""")
def crawl_bfs(spark, d):
    """What the crawls' roots reach by links within a host."""
    links = table(spark, d, "links").filter(U.origin("src") == U.origin("dst")).select(U.strip_slash("src").alias("src"), "pos", "dst")
    start = table(spark, d, "crawl_configs").filter("site_url IS NOT NULL").select(U.site_root("site_url").alias("url"), F.lit(0).cast("bigint").alias("seq"))
    return crawl.traverse(start, links, order=False).select("url")


@query()
def crawl_order(spark, d):
    """The same with round and queue order, over all links."""
    links = table(spark, d, "links").select(U.strip_slash("src").alias("src"), "pos", "dst")
    start = table(spark, d, "crawl_configs").filter("site_url IS NOT NULL").select(U.site_root("site_url").alias("url"), F.lit(0).cast("bigint").alias("seq"))
    return crawl.traverse(start, links).select("url", "depth", "place")


@query(f"""SELECT item_id, path, coalesce(len(backlinks), 0) AS n_backlinks, coalesce(TRY_CAST({HEADER.format('content-length')} AS BIGINT), 0) AS size, coalesce({HEADER.format('content-type')}, '') AS content_type, coalesce({HEADER.format('date')}, '') AS date
    FROM items WHERE bad_url IS NULL AND redir IS NULL""")
def crawl_log_report(spark, d):
    return crawl.crawl_log(table(spark, d, "items"))


@query(f"SELECT lower({SITE}) AS site, CASE WHEN bad_url IS NOT NULL THEN 'bad' WHEN redir IS NOT NULL THEN 'redirect' ELSE 'content' END AS kind, count(*) AS n FROM items GROUP BY 1, 2")
def item_kinds(spark, d):
    return table(spark, d, "items").select(U.site_name("site_url").alias("site"), crawl.kinds().alias("kind")).groupBy("site", "kind").agg(F.count("*").alias("n"))


@query("SELECT file_id, strftime(modified, '%a, %d %b %Y %H:%M:%S GMT') AS last_modified, octet_length(encode(body)) AS bytes FROM cache_files")
def file_headers(spark, d):
    return table(spark, d, "cache_files").select("file_id", U.http_date("modified").alias("last_modified"), F.octet_length(F.encode("body", "UTF-8")).cast("bigint").alias("bytes"))


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
