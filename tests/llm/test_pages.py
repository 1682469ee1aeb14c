"""Problems 1, 3, 6 and 7: operators on the lines of pages."""

import pytest
from pyspark.sql import functions as F

from lodestrand.llm import content, lines, residue, spam
from lodestrand.llm.pages import normal, plain, read_page, site_key, text_lines
from tests.conftest import rows

NAV = ['<ul class="nav">', '<li><a href="http://{s}/">Home</a></li>', '<li><a href="http://{s}/n">News</a></li>', '<li><a href="http://{s}/x{i}">About the {w} stable</a></li>', "</ul>"]
FOOT = ['<div id="foot">', "<p>Written for {s} in 20{i}.</p>", "<p>Every page of this house may be read aloud, but not sold.</p>", "</div>"]
WORDS = ["red", "blue", "green", "quick", "tidy", "bright", "heavy", "plain", "steep", "rusty", "empty", "calm"]


def page(i, body, site="a.test", box=True):
    w = WORDS[i % len(WORDS)]
    inner = ['<div class="main">', *body, "</div>"] if box else body
    return "\n".join(x.format(s=site, i=i, w=w) if x not in body else x for x in ["<html>", "<body>", *NAV, *inner, *FOOT, "</body>", "</html>"])


def prose(i, n=4):
    w = WORDS
    return [f"<h1>How the {w[i % 12]} mill was {i} years old</h1>"] + [f"<p>The {w[(i + k) % 12]} harbour of page {i} was painted, and the {w[(i * k) % 12]} ferry left early; nobody asked the {i + k} guests why.</p>" for k in range(n)]


@pytest.fixture(scope="module")
def items(spark):
    data = [(i, "http://A.test/" if i % 2 else "http://a.test", page(i, prose(i), box=i % 3 > 0), "extra") for i in range(40)]
    data += [
        (100, "http://a.test", page(100, ["<h1>Not Found</h1>", "<p>We could not find the page you were looking for.</p>"]), "extra"),
        (101, "http://a.test", page(101, ["<h1>{{ title }}</h1>", "<p>Dear {{ name }}, [[date]]</p>", "<p>The old harbour was painted again in the early spring.</p>"]), "extra"),
        (102, "http://a.test", page(102, ["<h1>News</h1>", "<p>Please enable JavaScript to view this page.</p>"]), "extra"),
        (103, "http://a.test", page(103, ["<h1>Lorem ipsum</h1>", "<p>Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore.</p>"]), "extra"),
        (104, "http://a.test", page(104, prose(1) + ["<p>Designers call such dummy words lorem ipsum, and a page not found says 404.</p>", "<pre>{{ title }}</pre>"]), "extra"),
        (105, "http://a.test", page(105, ["<h1>Cheap Mill</h1>"] + ["<p>" + " * ".join(f"cheap mill {w} buy" for w in WORDS) * 2 + "</p>"] * 3), "extra"),
        (106, "http://a.test", page(106, ["<h1>Cheap Links</h1>"] + [f'<li><a href="http://x{k}.test/">cheap {w} buy</a></li>' for k, w in enumerate(WORDS)]), "extra"),
        (110, "http://b.test", None, "extra"), (111, "http://b.test", "", "extra"), (112, None, "<p>A lone page without a site, of one line.</p>", "extra"),
    ]
    return spark.createDataFrame(data, "item_id bigint, site_url string, content_text string, line_no string").cache()


def test_reading():
    assert plain("<P CLASS=x>a &lt;b&gt; &amp;amp; <!-- no --> c</p>") == "a <b> &amp; c"
    assert plain("3 < x and y > 2") == "3 < x and y > 2"
    assert normal("Über 12,3") == "über 0,0" and site_key("HTTP://A.test/") == "http://a.test" and site_key(None) == ""
    assert text_lines("<p>a</p>\n<hr>\n\n--\n1") == [(1, "a"), (5, "1")] and text_lines(None) == []
    got = read_page('<div id=M>\n<td>\n<li><a href="http://b.test/">x</a></li>\n</div>\n<p>y', "http://a.test")
    assert [(x.no, x.leaf, x.away, x.boxes) for x in got] == [(3, "/div.m/td/li/a", 1, 2), (5, "/p", 0, 0)]


def test_own_content(items):
    got = {}
    for i, n in rows(content.content_lines(items)):
        got.setdefault(i, set()).add(n)
    text = {r["item_id"]: r["content_text"].split("\n") for r in items.filter("content_text IS NOT NULL").collect()}
    for i in range(40):
        want = {n for n, x in enumerate(text[i], 1) if "mill was" in x or "harbour of page" in x}
        assert got[i] == want, i
    assert all("cheap" in text[106][n - 1].lower() for n in got[106]) and len(got[106]) == 13
    assert got[112] == {1} and not {110, 111} & set(got)


def test_path_ratios_decide():
    """Lines that nothing repeats, in a side box: the ratio of their path rejects them, and without it they stay."""
    body = ["<html>", "<body>", "<div class=main>", "<h1>How the mill was built</h1>", "<p>The harbour was painted, and the ferry left early; nobody asked why.</p>", "</div>"]
    text = "\n".join([*body, "<div class=side>", "<li>Become a quarry member and save</li>", "<li>Desk open daily from ten</li>", "</div>", "</body>", "</html>"])
    lines = read_page(text, "http://a.test")
    entry = lambda value: [{"kind": content.PATH, "key": content.key(x.leaf), "value": value(x)} for x in lines]
    told = content.own_content(lines, content.Notes(entry(lambda x: 3.0 if "side" in x.box else 20.0)))
    assert told == [True, True, False, False]
    assert content.own_content(lines, content.Notes(entry(lambda x: 99.0))) == [True] * 4
    framed = content.Notes(entry(lambda x: 99.0), frozenset(content.frames_of(lines[2], normal(lines[2].text))))
    assert content.own_content(lines, framed) == [True, True, False, True]


def test_frames_are_learned_from_low_paths(spark):
    data = []
    for s in range(6):
        for i in range(12):
            side = ['<div class="side">', f"<li>Follow our {WORDS[i]} channels</li>", f"<li>{WORDS[(i + s) % 12]} {i}</li>", "</div>"]
            advert = [f"<p>Follow our {WORDS[(i + s) % 12]} {WORDS[s]} channels</p>"] if i % 3 == 0 else []
            data.append((100 * s + i, f"http://s{s}.test", "\n".join(["<html>", "<body>", *side, '<div class="main">', *prose(100 * s + i), *advert, "</div>", "</body>", "</html>"])))
    df = spark.createDataFrame(data, "item_id bigint, site_url string, content_text string")
    _, frames, _ = content.site_notes(content.pages_of(df))
    assert content.key("follow our") in frames
    text = {i: t.split("\n") for i, _, t in data}
    kept = [text[i][n - 1] for i, n in rows(content.content_lines(df))]
    assert len(kept) == 72 * 5 and not any("Follow our" in x for x in kept)


def test_foreign_backlinks(spark):
    links = lambda *urls: [(u, "x") for u in urls]
    data = [(1, "http://a.test/", links("http://b.test/1", "HTTP://c.test/2", "http://d.test")), (2, "http://a.test", links("http://A.test/1", "http://a.test/2", "http://a.test/3", "http://b.test")), (3, None, None), (4, "http://a.test", [])]
    df = spark.createDataFrame(data, "item_id bigint, site_url string, backlinks array<struct<url:string,name:string>>")
    assert rows(spam.foreign_links(df, "item_id", "site_url", "backlinks")) == [(1,)]


def test_copies_of_spam_do_not_vouch_for_each_other(spark):
    good = [(i, "http://a.test", page(i, prose(i)), None) for i in range(40)]
    bad = "\n".join(["<html>", "<body>", '<div class="main">', "<h1>Odd salad</h1>", "<p>" + " ".join(f"{WORDS[(7 * k) % 12]}{k} mill{k % 9}" for k in range(60)) + ".</p>", "</div>", "</body>", "</html>"])
    df = spark.createDataFrame([*good, *[(1000 + i, "http://c.test", bad, None) for i in range(30)]], "item_id bigint, site_url string, content_text string, backlinks array<struct<url:string,name:string>>")
    assert rows(spam.spam_pages(df)) == [(1000 + i,) for i in range(30)]


def test_content_of_no_rows(items):
    assert content.content_lines(items.limit(0)).count() == 0


def test_hot_sites_are_salted(items, monkeypatch):
    monkeypatch.setattr(content, "HOT_PAGES", 1)
    _, _, spread = content.site_notes(content.pages_of(items))
    assert spread["http://a.test"] > 1
    assert {i for i, _ in rows(content.content_lines(items))} >= set(range(40))


def test_residue(items):
    assert rows(residue.residue_rows(items)) == [(100, "error"), (101, "placeholder"), (102, "scripts"), (103, "filler")]


def test_copies_of_a_page_are_no_furniture(spark):
    """A group of copies of most rows of a site: of a page, of an error page and of a page of keywords."""
    error = page(1, ["<h1>Not Found</h1>", "<p>We could not find the page you were looking for.</p>"])
    stuffed = page(2, ["<h1>Cheap Mill</h1>"] + ["<p>" + " * ".join(f"cheap mill {w} buy" for w in WORDS) * 2 + "</p>"] * 3)
    sites = {"http://c.test": page(7, prose(7)), "http://d.test": error, "http://e.test": stuffed}
    data = [(1000 * k + i, s, page(i, prose(i)) if i < 10 else copied) for k, (s, copied) in enumerate(sites.items()) for i in range(40)]
    df = spark.createDataFrame(data, "item_id bigint, site_url string, content_text string")
    got = {}
    for i, n in rows(content.content_lines(df)):
        got.setdefault(i, []).append(n)
    assert all(len(got[i]) == 5 for i in range(40))
    assert [i for i, _ in rows(residue.residue_rows(df))] == list(range(1010, 1040))
    assert [i for i, in rows(spam.spam_pages(df))] == list(range(2010, 2040))


@pytest.mark.parametrize(("parts", "want"), [
    ([("h1", "Seite nicht gefunden"), ("p", "Die gewünschte Seite ist leider nicht vorhanden.")], "error"), ([("p", "Veuillez activer les scripts pour afficher la page.")], "scripts"),
    ([("p", "<%= x %>")], "placeholder"), ([("p", "test test aaa bla qwer foo test")], "filler"), ([("pre", "${x}")], None), ([], None), ([("p", "")], None),
    ([("p", "Short but real text stands here, as it should.")], None), ([("p", "x" * 200_000)], None),
])
def test_residue_of_parts(parts, want):
    assert residue.residue(parts) == want


def test_spam(items):
    assert rows(spam.spam_pages(items, backlinks=None)) == [(105,), (106,)]
    assert spam.spam_pages(items.limit(0), backlinks=None).count() == 0


def test_scores_against_brute_force(items):
    """Mutual information by the operator and by plain counting."""
    import math
    from collections import Counter

    kept = {}
    for i, n in rows(content.content_lines(items)):
        kept.setdefault(i, []).append(n)
    text = {r["item_id"]: r["content_text"].split("\n") for r in items.filter("content_text IS NOT NULL").collect()}
    seqs = {i: [spam.WORD.findall(plain(text[i][n - 1]).lower()) for n in ns] for i, ns in kept.items()}
    uni, bi = Counter(), Counter()
    for s in seqs.values():
        uni.update({w for ws in s for w in ws})
        bi.update({p for ws in s for p in zip(ws, ws[1:], strict=False)})
    scored = spam.scores(content.pages_of(items)).collect()
    assert {r["item_id"] for r in scored} >= {105, 106}
    for r in scored:
        pairs = [p for ws in seqs[r["item_id"]] for p in zip(ws, ws[1:], strict=False)]
        each = [math.log(((bi[p] - 1 if bi[p] > spam.SEEN else 0) + spam.UNSEEN) / min(max(uni[p[0]] - 1, 1), max(uni[p[1]] - 1, 1))) for p in pairs]
        want = sum(each) / len(pairs)
        error = math.sqrt(sum((x - want) ** 2 for x in each) / len(pairs) / len(set(pairs)))
        assert abs(r["pmi"] - want) < 1e-9 and abs(r["error"] - error) < 1e-6 and abs(r["repeated"] - (1 - len(set(pairs)) / len(pairs))) < 1e-9


def test_every_page_is_scored(spark):
    """Salad of a third or more of function words is found, ordinary writing of words that no other page has is not."""
    import random

    rng = random.Random(5)
    known = " ".join(plain(x) for i in range(12) for x in prose(i)).lower().replace(",", " ").replace(";", " ").replace(".", " ").replace("?", " ").split()
    salad = " ".join(rng.sample([w for w in known if w.isalpha()], 90))
    assert sum(w in spam.FUNCTION for w in salad.split()) >= spam.SENTENCES * 90
    rare = "A stranger arrived by the night coach and took the smallest of our rooms without a word to anybody"
    wrap = lambda body: "\n".join(["<html>", "<body>", '<div class="main">', "<h1>Odd page</h1>", f"<p>{body}.</p>", "</div>", "</body>", "</html>"])
    data = [*((i, "http://a.test", page(i, prose(i))) for i in range(40)), (200, "http://c.test", wrap(salad)), (201, "http://d.test", wrap(rare))]
    df = spark.createDataFrame(data, "item_id bigint, site_url string, content_text string")
    assert {r["item_id"] for r in spam.scores(content.pages_of(df)).collect()} == {*range(40), 200, 201}
    assert rows(spam.spam_pages(df)) == [(200,)]


def read_by_hand(pages):
    """What read_pages gives an operator, without Spark."""
    for i, text in enumerate(pages):
        lines = read_page(text, "http://a.test")
        yield None, i, lines, [True] * len(lines)


def test_blocks_bound_what_is_held(monkeypatch):
    """However many pages a task has, a batch holds one block; and the blocks together count what one block counts."""
    from collections import Counter
    from types import SimpleNamespace

    monkeypatch.setattr(spam, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    pages = ["", "lone", *("\n".join(prose(i)) for i in range(200))]
    counts, blocks = [], []
    for most in (100, spam.BLOCK):
        monkeypatch.setattr(spam, "BLOCK", most)
        batches = list(spam._scan(read_by_hand(pages)))
        assert all(b.num_rows <= 2 * (most + 100) for b in batches)
        table = [r for b in batches for r in b.to_pylist()]
        blocks.append({r["block"] for r in table})
        counted = Counter()
        for r in table:
            if r["kind"] == spam.KEY:
                counted[r["key"]] += r["n"]
        counts.append(counted)
        assert sorted(r["item_id"] for r in table if r["kind"] == spam.PAGE) == list(range(2, 202))
    assert len(blocks[0]) > 50 and len(blocks[1]) == 1 and min(blocks[0]) == 3 << 32
    assert counts[0] == counts[1]


def repeated_by_hand(items, min_items=8, share=0.1):
    from collections import Counter

    n, total, per = Counter(), Counter(), []
    for r in items.filter("content_text IS NOT NULL").collect():
        site = site_key(r["site_url"])
        total[site] += 1
        own = [(no, normal(t)) for no, t in text_lines(r["content_text"])]
        n.update({(site, x) for _, x in own})
        per.append((r["item_id"], site, own))
    return sorted((i, no) for i, site, own in per for no, x in own if n[site, x] >= min_items and n[site, x] >= share * total[site])


def test_repeated_lines(items):
    assert sorted(rows(lines.repeated_lines(items))) == repeated_by_hand(items) != []
    assert lines.repeated_lines(items.limit(0)).count() == 0


def test_near_lines_and_removal(spark):
    data = [(i, "s", f"Written by {a} Kes, the mill house\nOwn text of page number {chr(97 + i)}") for i, a in enumerate("Ada Bo Cid Dee Eli Fay Gil Hal Ivo Jon".split())]
    df = spark.createDataFrame(data, "item_id bigint, site_url string, content_text string")
    assert lines.repeated_lines(df).count() == 0
    near = lines.repeated_lines(df, near=True)
    assert rows(near.filter("line_no = 1"), "item_id") == [(i,) for i in range(10)]
    out = lines.without_lines(df, near.filter("line_no = 1"))
    assert [r["content_text"] for r in out.orderBy("item_id").collect()] == [f"Own text of page number {chr(97 + i)}" for i in range(10)] and out.columns == df.columns


def test_long_pages(spark):
    body = "\n".join(f"<p>Line {i} of a very long page, which goes on.</p>" for i in range(3_000))
    df = spark.createDataFrame([(1, "s", body), (1, "s", body), (None, "s", "<p>x</p>")], "item_id bigint, site_url string, content_text string")
    assert content.content_lines(df).filter(F.col("item_id").isNotNull()).count() == 6_000
    assert lines.repeated_lines(df, min_items=2).count() == 6_000
