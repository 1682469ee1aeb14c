"""The schemas of the data model, as DDL: fetched responses, links, items, MIME types and crawl options."""

from __future__ import annotations

_FILE = "struct<data:binary,filename:string,mimetype:string>"


FETCH = "url string, final_url string, status int, content_info map<string,string>, body binary, html string, error string, fetched_at timestamp_ntz, loaded_at timestamp_ntz"
LINK = "src string, seq bigint, pos int, dst string, raw string, fragment string, attr string, name string"
ITEM = (
    "item_id bigint, bad_url string, path string, orig_path string, site_url string, redir string, sortorder bigint, backlinks array<struct<url:string,name:string>>, "
    f"content_info map<string,string>, content_text string, content_bin binary, html_raw string, type string, mimetype string, remote_url string, text string, file {_FILE}, image {_FILE}"
)
TYPES = "mimetype string, type string"
CONFIG = (
    "site_url string, ignore array<string>, whitelist array<string>, start_urls array<string>, max bigint, maxsize bigint, cache string, post_only boolean, ignore_robots boolean, "
    "patterns array<string>, subs array<string>"
)

# The content type of each MIME type; any other is a File.
MIME_TYPES = {
    "text/plain": "File",
    "application/msword": "File",
    "application/vnd.ms-word": "File",
    "application/pdf": "File",
    "application/x-pdf": "File",
    "application/vnd.ms-excel": "File",
    "application/msexcel": "File",
    "application/vnd.ms-powerpoint": "File",
    "text/xhtml": "Document",
    "text/html": "Document",
    "image/bmp": "Image",
    "image/jpeg2000": "Image",
    "image/png": "Image",
    "image/svg+xml": "Image",
    "image/tiff": "Image",
    "image/jpeg": "Image",
    "image/gif": "Image",
}
OTHER_TYPE = "File"
# MIME types by file extension, for paths whose response names none.
EXTENSIONS = {
    "txt": "text/plain", "htm": "text/html", "html": "text/html", "css": "text/css", "csv": "text/csv", "xml": "text/xml", "js": "application/javascript", "json": "application/json",
    "pdf": "application/pdf", "doc": "application/msword", "xls": "application/vnd.ms-excel", "ppt": "application/vnd.ms-powerpoint", "zip": "application/zip",
    "bmp": "image/bmp", "png": "image/png", "svg": "image/svg+xml", "tif": "image/tiff", "tiff": "image/tiff", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif",
}
HTML_TYPES = ("text/html", "text/xhtml", "application/xhtml+xml")
INDEX_NAMES = (".content", "index.html", "index.htm", "index_html")  # in order of precedence
EMPTY_MARK = "<EMPTYSTRING>"  # stands for an empty substitute in options
