"""URLs, paths and headers as Column functions, all inside the JVM.

Each gives NULL for NULL unless its docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrand.schema import EXTENSIONS


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def site_root(url: Column | str) -> Column:
    """A site's URL without its last slash."""
    return F.regexp_replace(_c(url), "/$", "")


def site_name(url: Column | str) -> Column:
    """The form in which two spellings of a site are the same: lower case, no last slash."""
    return F.lower(site_root(url))


def origin(url: Column | str) -> Column:
    """scheme://host of an absolute URL in lower case; NULL of any other."""
    hit = F.regexp_extract(_c(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    return F.when(hit != "", F.lower(hit))


def in_site(url: Column | str, site: Column | str, strict: bool = False) -> Column:
    """The URL begins as the site does, without regard to the site's last slash. strict: at a path boundary, which keeps
    http://a.com.evil out of http://a.com."""
    root = site_root(site)
    if not strict:
        return F.startswith(_c(url), root)
    rest = F.substr(_c(url), F.length(root) + 1)
    return F.startswith(_c(url), root) & ((rest == "") | rest.rlike("^[/?#]"))


def collapse_slashes(path: Column | str) -> Column:
    """The path without empty segments: no leading, trailing or double slash."""
    return F.array_join(F.filter(F.split(_c(path), "/"), lambda x: x != ""), "/")


def unquote_plus(text: Column | str) -> Column:
    """Percent escapes decoded as UTF-8 and plus signs as spaces; an escape that is none stays as it is."""
    return F.url_decode(F.regexp_replace(_c(text), "%(?![0-9A-Fa-f]{2})", "%25"))


def site_path(url: Column | str, site: Column | str) -> Column:
    """The path of a URL within its site: the rest after the site's URL, slashes collapsed, then decoded."""
    return unquote_plus(collapse_slashes(F.substr(_c(url), F.length(site_root(site)) + 1)))


def strip_fragment(url: Column | str) -> Column:
    return F.regexp_replace(_c(url), "(?s)#.*$", "")


def fragment(url: Column | str) -> Column:
    """What follows the first '#', NULL where there is none."""
    return F.when(F.instr(_c(url), "#") > 0, F.regexp_replace(_c(url), "(?s)^[^#]*#", ""))


def strip_slash(url: Column | str) -> Column:
    """Without one last slash."""
    return F.regexp_replace(_c(url), "/$", "")


def post_url(url: Column | str) -> Column:
    """The URL to post to: without its query."""
    return F.regexp_replace(_c(url), r"(?s)\?.*$", "")


def post_body(url: Column | str) -> Column:
    """The query to post, NULL where there is none."""
    return F.when(F.instr(_c(url), "?") > 0, F.regexp_replace(_c(url), r"(?s)^[^?]*\?", ""))


def cache_key(url: Column | str, post_only: Column) -> Column:
    """What a response is kept under: the URL; a post's URL and body, the query standing once."""
    return F.when(post_only & (F.instr(_c(url), "?") > 0), F.concat_ws("?", post_url(url), post_body(url))).otherwise(_c(url))


def squash(text: Column | str) -> Column:
    """White space collapsed to single spaces and trimmed."""
    return F.trim(F.regexp_replace(_c(text), r"\s+", " "))


def header(info: Column | str, name: str, default: str | None = "") -> Column:
    """A header by its name in any case; the default where it or the whole map is missing or NULL."""
    entry = F.filter(F.map_entries(_c(info)), lambda e: F.lower(e["key"]) == name.lower())
    return F.coalesce(F.get(entry, F.lit(0))["value"], F.lit(default))


def media_type(content_type: Column | str) -> Column:
    """The MIME type of a Content-Type header: before the first ';', lower case, trimmed."""
    return F.lower(F.trim(F.split_part(_c(content_type), F.lit(";"), F.lit(1))))


def charset(content_type: Column | str) -> Column:
    """The charset that a Content-Type header names, '' for none."""
    return F.coalesce(F.lower(F.regexp_extract(_c(content_type), r"""(?i)charset\s*=\s*["']?([^\s;"']+)""", 1)), F.lit(""))


def filename(path: Column | str) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def extension(path: Column | str) -> Column:
    """What follows the last '.', the whole path where there is none."""
    return F.element_at(F.split(_c(path), r"\."), -1)


def guess_mime(path: Column | str) -> Column:
    """The MIME type that the file name's extension stands for, NULL for an unknown or missing one."""
    name = F.lower(F.regexp_extract(filename(F.regexp_replace(_c(path), r"[?#].*$", "")), r"\.([A-Za-z0-9]+)$", 1))
    return F.element_at(F.create_map(*(F.lit(x) for kv in EXTENSIONS.items() for x in kv)), name)


def cache_file(path: Column | str) -> Column:
    """The file that keeps a path: a directory's content is in its index.html."""
    return F.when((_c(path) == "") | F.endswith(_c(path), F.lit("/")), F.concat(_c(path), F.lit("index.html"))).otherwise(_c(path))


def quote(text: Column | str) -> Column:
    """Percent-encoded for a path: slashes stay, a space is %20."""
    return F.replace(F.replace(F.replace(F.url_encode(_c(text)), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/")), F.lit("%7E"), F.lit("~"))


def http_date(ts: Column | str) -> Column:
    """A timestamp without zone as an HTTP date."""
    return F.date_format(_c(ts), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#;]*)(.*)$"


def relative_url(source: Column | str, target: Column | str) -> Column:
    """The target as seen from the source. Another scheme or host: the target as it is. Else the segments both paths
    begin with are dropped and each further one of the source but the last becomes '..'; the target's parameters, query
    and fragment stay. Equal paths give their last segment; from 'a/' to 'a' it is '../a'."""
    s, t = _c(source), _c(target)
    part = lambda x, i: F.regexp_extract(x, _URL, i)
    a, b = F.split(part(s, 3), "/"), F.split(part(t, 3), "/")
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("on"))
    step = lambda acc, same: F.struct((acc["n"] + F.when(acc["on"] & same, 1).otherwise(0)).alias("n"), (acc["on"] & same).alias("on"))
    n = F.aggregate(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), start, step, lambda acc: acc["n"])
    rest_a, rest_b = F.slice(a, n + 1, F.size(a)), F.slice(b, n + 1, F.size(b))
    last = F.element_at(b, -1)
    path = (
        F.when((F.size(rest_a) == 0) & (F.size(rest_b) == 0), last)
        .when((F.size(rest_a) == 1) & (F.get(rest_a, F.lit(0)) == "") & (F.size(rest_b) == 0), F.concat(F.lit("../"), last))
        .otherwise(F.array_join(F.concat(F.array_repeat(F.lit(".."), F.greatest(F.size(rest_a) - 1, F.lit(0))), rest_b), "/"))
    )
    apart = (part(s, 1) != part(t, 1)) | (part(s, 2) != part(t, 2))
    return F.when(apart, t).otherwise(F.concat(path, part(t, 4)))
