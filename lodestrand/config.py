"""The options of a crawl, as a value."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.request import pathname2url

from lodestrand.schema import EMPTY_MARK


def java_regex(pattern: str) -> str:
    """A Python regular expression in Java's spelling: named groups are (?<n>...), references to them \\k<n>."""
    return re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<"))


def java_substitute(sub: str) -> str:
    """A Python replacement in Java's spelling: \\1 is $1, \\g<n> is ${n} or $n; a dollar sign is literal."""
    out = re.sub(r"(?<!\\)\$", r"\\$", sub)
    out = re.sub(r"\\g<(\d+)>", r"$\1", out)
    out = re.sub(r"\\g<(\w+)>", r"${\1}", out)
    return re.sub(r"\\(\d)", r"$\1", out)


def regex_list(text: str | None) -> tuple[str, ...]:
    """One pattern to a line; blank lines are none."""
    return tuple(x.strip() for x in (text or "").split("\n") if x.strip())


@dataclass(frozen=True)
class CrawlConfig:
    """What one crawl is told. Build it with `of` from a section's strings, or directly."""

    site_url: str
    ignore: tuple[str, ...] = ()
    whitelist: tuple[str, ...] = ()
    start_urls: tuple[str, ...] = ()
    max: int | None = None
    maxsize: int | None = None
    cache: str | None = None
    post_only: bool = False
    ignore_robots: bool = False
    strict_prefix: bool = False
    patches: tuple[tuple[str, str], ...] = field(default=())

    @staticmethod
    def of(options: Mapping[str, str]) -> CrawlConfig:
        """From option strings. `url` stands for `site_url` and `ignore-robots` for `ignore_robots` where the other is
        absent; a site_url that is an existing path becomes a file URL; the URL always ends in a slash. Patterns and
        substitutes go together line by line as far as both reach; a line of nothing is skipped, EMPTY_MARK deletes."""
        get = lambda *names: next((options[n].strip() for n in names if options.get(n, "").strip()), "")
        url = get("site_url", "url")
        if not url:
            raise ValueError("a crawl needs site_url")
        if os.path.exists(url):
            url = "file://" + pathname2url(os.path.abspath(url))
        url = url if url.endswith("/") else url + "/"
        pairs = zip(options.get("patterns", "").split("\n"), options.get("subs", "").split("\n"), strict=False)
        return CrawlConfig(
            site_url=url,
            ignore=regex_list(options.get("ignore")),
            whitelist=regex_list(options.get("whitelist")),
            start_urls=tuple(get("start-urls", "start_urls").split()),
            max=int(get("max")) if get("max") else None,
            maxsize=int(get("maxsize")) if get("maxsize") else None,
            cache=get("cache") or None,
            post_only=get("post-only", "post_only").lower() in ("true", "yes"),
            ignore_robots=get("ignore_robots", "ignore-robots").lower() in ("true", "on", "yes"),
            strict_prefix=get("strict_prefix").lower() in ("true", "yes"),
            patches=tuple((p.strip(), "" if s.strip() == EMPTY_MARK else s.strip()) for p, s in pairs if p.strip() and s.strip()),
        )
