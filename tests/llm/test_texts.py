"""Problems 4, 5, 8, 9 and 10."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrand.llm import cut, markup, mixing, neardup, tokens
from tests.conftest import rows

needs_vocabulary = pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary")


# ---------------------------------------------------------------- near-duplicates


def texts(n=120, seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    out = []
    for _ in range(n):
        base = rng.choices(vocab, k=rng.randint(200, 320))
        out.append(base)
        for _ in range(rng.choice((0, 0, 1, 2))):
            copy = list(base)
            for _ in range(rng.randint(0, 30)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append(copy)
    return [" ".join(x) for x in out]


def brute(docs, threshold=0.6):
    sets = {i: set(neardup.Shingles(3, 200).of(t).tolist()) for i, t in docs if t and len(neardup.WORD.findall(t)) >= 200}
    return sorted((a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9)


def test_join_finds_every_pair(spark):
    docs = list(enumerate(texts()))
    docs += [(1000, docs[0][1]), (1001, docs[0][1].upper()), (1002, "<p>" + docs[0][1].replace(" ", " &nbsp; ") + "</p>"), (1003, None), (1004, ""), (1005, "too short")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "item_id bigint, content_text string, doc string")
    join = neardup.join_texts(df, limit=4)
    docs[-4] = (1002, docs[0][1])
    assert sorted(rows(join.pairs())) == brute(docs)
    groups = {r["doc"]: r for r in join.groups().collect()}
    assert {groups[i]["group_id"] for i in (0, 1000, 1001, 1002)} == {0} and groups[1000]["rep"] == 0 and 1003 not in groups
    for a, b in brute(docs):
        assert groups[a]["group_id"] == groups[b]["group_id"]


def test_large_leaves_that_never_split(spark):
    base = texts(1, 9)[0].split()
    df = spark.createDataFrame([(i, " ".join([f"v{i}", *base])) for i in range(40)], "item_id bigint, content_text string")
    assert neardup.join_texts(df, limit=3).pairs().count() == 40 * 39 // 2


def test_a_family_of_near_copies_is_compared_where_it_first_meets(spark):
    base = texts(1, 9)[0].split()
    change = lambda i: [f"v{i}" if (k * 7 + i) % 97 == 0 else w for k, w in enumerate(base)]
    df = spark.createDataFrame([(i, " ".join(change(i))) for i in range(300)], "item_id bigint, content_text string")
    join = neardup.join_texts(df)
    leaves = join._leaves()
    first = join.repeats * 2**neardup.FIRST_DEPTH
    assert leaves.count() <= 2 * first * 300  # splitting on to the deepest level would give thousands of rows a set
    assert leaves.agg({"size": "max"}).first()[0] > 16
    want = {(a, b) for a, b in brute(list(enumerate(r["content_text"] for r in df.orderBy("item_id").collect())))}
    got = {(r["a"], r["b"]) for r in join.links.collect()}
    assert got <= want and len(got) >= 0.99 * len(want) > 1000


def test_join_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b c")], "item_id bigint, content_text string")
    join = neardup.join_texts(df)
    assert join.pairs().count() == 0 and join.groups().count() == 0
    assert neardup.join_texts(df.limit(0)).pairs().count() == 0


def test_trees_reach_the_target_recall():
    """The estimate against pairs at the threshold, and the number of trees that comes of it."""
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**32, (400, neardup.TOKENS), dtype=np.uint32)
    b = np.where(rng.random(a.shape) < 0.6, a, rng.integers(0, 2**32, a.shape, dtype=np.uint32))
    repeats = neardup.repeats_for(0.6)
    assert neardup.recall(0.6, repeats) >= neardup.RECALL > neardup.recall(0.6, repeats - 1) and neardup.recall(0.6, 7) < 0.99
    roots = np.tile(neardup.mix(np.arange(1, repeats + 1, dtype=np.uint64)), 400)
    row = np.repeat(np.arange(400), repeats)
    (ra, na), (rb, nb) = (neardup.children(x, row, roots, 7) for x in (a, b))
    met = sum(bool(np.intersect1d(na[ra == i], nb[rb == i]).size) for i in range(400))
    assert abs(met / 400 - neardup.recall(0.6, repeats, 7)) < 0.02


def test_embedding_estimates_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 900, dtype=np.uint64)
    same = (neardup.embed(x[:800]) == neardup.embed(x[100:])).mean()
    assert abs(same - 700 / 900) < 0.15


# ---------------------------------------------------------------- markup


@pytest.mark.parametrize(("text", "want"), [
    ("<p>a</p>", ["html"]), ("a &nbsp; b", ["html"]), ("a <!-- b --> c", ["html"]), ("# Head\ntext", ["markdown"]), ("Head\n=====\ntext", ["markdown"]), ("see [a](b.html)", ["markdown"]),
    ("use `code` here", ["markdown"]), ("|a|b|\n|---|---|\n|1|2|", ["markdown"]), ("== Head ==\ntext", ["wiki"]), ("see [[A|b]] or '''c'''", ["wiki"]), ("{| class=x\n| a || b\n|-\n|}", ["wiki"]),
    ("\\section{A} text", ["latex"]), ("where $x_{1} = 2$ holds", ["latex"]), ("he said ``so''.", ["latex"]), ("<b>x</b> and **y**", ["html", "markdown"]),
    ("The value rises from 3 < x to x = 9 * 2 > 1.", []), ("It costs $40, the other $60.", []), ("See [1] and note [2] in list_b.", []), ("C# and file_name_v2 on the R&D shelf", []), ("- a\n- b\n• c\n1) d", []),
    ("=====", []), ("", []), (None, []), ("a" * 300_000, []), ("< p >", []),
])
def test_languages(text, want):
    assert list(markup.labels(text)) == want


@pytest.mark.parametrize(("text", "want"), [
    ("<h2>A &amp; B</h2><p>x<br>y</p><ul><li>1<li>2</ul><pre>if a &lt; b:\n  c</pre><table><tr><th>k</th><td>v</td></tr></table>", "## A & B\n\nx\ny\n\n- 1\n- 2\n\n    if a < b:\n      c\n\nk\tv"),
    ("Title\n===\n**bold** [t](u) ~~s~~\n```\ncode *x*\n```\n* item\n|a|b|\n|---|---|\n|1|2|", "# Title\nbold t s\n    code *x*\n- item\na\tb\n1\t2"),
    ("== H ==\n*[[a|b]]\n'''c''' [[File:x.png|thumb|d]]\n{|\n! k !! l\n|-\n| 1 || 2\n|}", "# H\n- b\nc d\nk\tl\n1\t2"),
    ("\\section{H}\n\\begin{itemize}\n\\item a\n\\end{itemize}\nx~\\cite{y} \\textbf{z} $a_{1}$\n\\begin{equation}\nE = \\sqrt{2}\n\\end{equation}", "## H\n\n- a\nx z $a_{1}$\n\\begin{equation}\nE = \\sqrt{2}\n\\end{equation}"),
    ("plain  text\r\n", "plain  text\r\n"), (None, None), ("", ""),
])
def test_clean(text, want):
    assert markup.clean(text) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7), st.randoms(use_true_random=False))
def test_min_cut_is_minimal(n, rng):
    source, sink = [rng.randint(0, 6) for _ in range(n)], [rng.randint(0, 6) for _ in range(n)]
    edges = {(i, j): rng.randint(0, 4) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}
    cost = lambda s: sum(sink[i] if s[i] else source[i] for i in range(n)) + sum(c for (i, j), c in edges.items() if s[i] != s[j])
    got = markup.min_cut(n, source, sink, edges)
    assert cost(got) == min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(2**n))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.randoms(use_true_random=False))
def test_cut_of_a_chain(n, rng):
    source, sink, near = ([rng.randint(0, 4) for _ in range(k)] for k in (n, n, n - 1))
    assert markup.chain_cut(source, sink, near) == markup.min_cut(n, source, sink, {(i, i + 1): c for i, c in enumerate(near)})


def test_plain_texts_try_no_pattern(monkeypatch):
    plain = "It costs 40 - or so (see [1]) - and 3 = 3, they said; nobody's list_b: a, b.\nA second line."
    monkeypatch.setattr(markup, "OWN", {})  # any use of a pattern would be a KeyError
    monkeypatch.setattr(markup, "SIGNS", {})
    assert markup.labels(plain) == {} and all(markup.constructs([plain], plain, x) == [[]] for x in markup.ORDER)
    assert all(markup.signs("A second line.", x) == set() for x in markup.ORDER)


MARKS = ["<", ">", "&", "amp;", "#", " ", "\n", "=", "==", "*", "~", "[", "]", "(", ")", "`", "|", "-", "---", ":", "'", "''", "{", "}", "\\", "$", "^", "_", "a", "1", "١", "p", "!", "http://a", "ref", "/ref", "nowiki", "REDIRECT", "section", "."]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(MARKS), max_size=14).map("".join))
def test_hints_miss_no_pattern(text):
    for x in markup.ORDER:
        assert markup.hinted(text, x) or not markup.OWN[x].search(text)
        for b in text.split("\n"):
            assert markup.signs(b, x) == {f"sign {m.lastgroup}" for m in markup.SIGNS[x].finditer(b)}


def test_every_construct_has_a_hint():
    samples = {
        "html": ["<p>", "<!-- a", "<!DOCTYPE html", "&eacute;"],
        "markdown": ["# a", "a\n===", "**a**", "~~a~~", "[a](b)", "```", "`a`", "---|"],
        "wiki": ["== a ==", "[[a]]", "'''a'''", "''a''", "{{a}}", "{| a", "|}", "|-", "[http://a b]", "<ref>", "</ref>", "<nowiki>", "#REDIRECT a"],
        "latex": ["\\begin{a}", "\\section", "\\S", "$a_1$", "\\[", "\\(", "``a''"],
    }
    for x, texts in samples.items():
        kinds = set()
        for s in texts:
            own = markup.constructs(s.split("\n"), s, x)
            assert any(own), (x, s)
            kinds |= {k for ks in own for k in ks}
        assert kinds == set(markup.OWN_KINDS[x])


def test_only_blocks_of_the_language_are_cleaned():
    plain = ["About 5~6 days in C:\\Section.", "A first plain line.", "A second plain line.", "A third plain line."]
    assert markup.clean("\n".join([*plain, "\\emph{a}~b"])) == "\n".join([*plain, "a b"])
    assert markup.clean("* x | y\n\nplain one\nplain two\nplain three\nsee [[A|b]]") == "* x | y\n\nplain one\nplain two\nplain three\nsee b"
    code = [f"line {i} of code" for i in range(40)]
    assert markup.clean("\n".join(["```", *code, "```"])) == "\n".join("    " + x for x in code).strip("\n")
    assert markup.clean("\n".join(["a <b", *["class"] * 9, ">c</b>", "x"])) == "a c\nx"
    assert list(markup.labels("\n".join([*plain, "one <br> sign", *plain]))) == ["html"]  # one construct is markup


def test_html_of_items_is_cleaned(spark, tmp_path):
    from lodestrand.llm import queries

    spark.createDataFrame([(1, "<!DOCTYPE html>\n<meta charset=x><h1>A</h1><P>b", "x"), (2, None, "x"), (3, "plain", None)], "item_id bigint, html_raw string, content_text string").write.parquet(str(tmp_path / "items.parquet"))
    assert rows(queries.queries()["p5_clean_html"](spark, str(tmp_path)), "item_id", "markup", "text") == [(1, "html", "# A\n\nb"), (2, "", None), (3, "", "plain")]


def test_markup_table(spark):
    df = spark.createDataFrame([(1, "<b>x</b> '''y'''", "a"), (1, "<b>x</b>", "a"), (2, None, "a"), (3, "plain", "a")], "doc_id bigint, text string, markup string")
    assert rows(markup.markup_languages(df)) == [(1, "html"), (1, "html"), (1, "wiki")]
    assert rows(markup.clean_texts(df)) == [(1, "html", "x"), (1, "html,wiki", "x y"), (2, "", None), (3, "", "plain")]
    assert markup.markup_languages(df.limit(0)).count() == 0


# ---------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(tokens.VOCABULARY)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def bpe():
    with open(tokens.VOCABULARY, encoding="utf-8") as f:
        return tokens.Bpe(f.read())


HARD = ["", " ", "\r\n\t ", "<|endoftext|>", "a" * 3000, "ab" * 900, "漢字" * 800, "e\u0301" * 300, "I'LL don't  x", "\U0001f600\u200d\U0001f525", "aaaa" * 17 + "b", "\x00\x01"]


@needs_vocabulary
@settings(max_examples=120, deadline=None)
@given(texts=st.lists(st.text(max_size=80), max_size=8))
def test_ids_are_those_of_the_library(bpe, reference, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    offsets, ids = bpe.encode(texts)
    for i, t in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == reference.encode(t, add_special_tokens=False).ids


@needs_vocabulary
def test_hard_texts(bpe, reference):
    offsets, ids = bpe.encode([*HARD, None])
    for i, t in enumerate([*HARD, ""]):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == reference.encode(t, add_special_tokens=False).ids, t[:20]


@needs_vocabulary
def test_token_table(spark, reference):
    df = spark.createDataFrame([(1, "Hello world", 5), (1, None, 5), (2, "", 5)], "doc_id bigint, text string, ids int")
    want = reference.encode("Hello world", add_special_tokens=False).ids
    assert rows(tokens.token_ids(df)) == sorted([(1, want), (1, []), (2, [])], key=repr)
    assert rows(tokens.token_counts(df)) == [(1, 0), (1, len(want)), (2, 0)]
    assert tokens.token_ids(df.limit(0)).count() == 0


# ---------------------------------------------------------------- mixing


def test_allotment():
    got = mixing.allot(100.0, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 1000.0, "b": 10.0, "c": 1000.0})
    assert got["b"] == 10 and abs(got["a"] / got["c"] - 2.5) < 1e-9 and abs(sum(got.values()) - 100) < 1e-9
    assert mixing.allot(100.0, {"a": 1.0}, {"a": 30.0}) == {"a": 30.0} and mixing.allot(1.0, {}, {}) == {}


@needs_vocabulary
def test_mix(spark):
    rng = random.Random(5)
    data = [(i, rng.choice(("big",) * 6 + ("small", "tiny")), " ".join(["word"] * rng.randint(5, 60))) for i in range(1500)] + [(5000, None, "x y"), (5001, "other", "x"), (5002, "big", None), (5003, "big", "")]
    df = spark.createDataFrame(data, "doc_id bigint, source string, text string").withColumn("tokens", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 4), ("tiny", 0.2, 1), ("none", 0.0, 3)], "source string, target_share double, max_repeats int")
    out = mixing.copies(df, targets).cache()
    assert out.count() == len(data)
    odd = {r["doc_id"]: r["copies"] for r in out.filter("doc_id >= 5000").collect()}
    assert odd == {5000: 0, 5001: 0, 5002: 0, 5003: 0}
    assert out.filter("source = 'big' AND copies > 1 OR source = 'small' AND copies > 4 OR source = 'tiny' AND copies > 1").count() == 0
    shares = {r["source"]: r for r in mixing.shares(out, targets).collect()}
    assert abs(sum(r["actual_share"] for r in shares.values()) - 1) < 1e-9 and shares["none"]["actual_share"] == 0
    # tiny gives all it has; the others keep their proportion
    assert abs(shares["tiny"]["repeats"] - 1) < 0.01
    assert abs(shares["big"]["actual_share"] / shares["small"]["actual_share"] - 5 / 3) < 0.03
    exact = mixing.copies(df, targets, total_tokens=3000)
    assert abs(exact.agg(F.sum(F.col("copies") * F.col("tokens"))).first()[0] - 3000) < 150


@needs_vocabulary
def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    out = mixing.copies(df, targets)
    assert out.count() == 0 and mixing.shares(out, targets).first()["actual_share"] == 0


# ---------------------------------------------------------------- cut texts


def corpus():
    rng = random.Random(2)
    noun, verb = [f"noun{chr(97 + i)}" for i in range(12)], ["painted", "opened", "moved", "closed"]
    sentence = lambda: f"The committee {rng.choice(verb)} a {rng.choice(noun)} and then went home because the {rng.choice(noun)} could not wait."
    out = [(i, " ".join(sentence() for _ in range(6)), "s") for i in range(200)]
    return out, sentence


def test_cut_texts(spark):
    docs, sentence = corpus()
    whole = [(300, docs[0][1] + "\n- item", "s"), (301, docs[0][1] + "\nAda Bo, Kesby", "s"), (302, "“" + docs[1][1] + "”", "s"), (303, docs[1][1] + "  \r\n", "s"), (304, None, "s"), (305, "", "s"), (306, " \n", "s"), (307, "Two words", "s"), (308, docs[1][1] + " (contact us)", "s")]
    cut_ = [(400, docs[2][1] + " The committee painted a", "t"), (401, docs[2][1] + " The committee pain", "t"), (402, docs[2][1] + " The commi…", "t"), (403, docs[2][1] + " The [more]", None), (404, docs[2][1] + " <a hre", "t"), (405, docs[2][1] + " The nou\ufffd", "t"), (406, docs[2][1][:-1], "t")]
    df = spark.createDataFrame(docs + whole + cut_, "doc_id bigint, text string, source string").withColumn("w", F.lit(1))
    assert rows(cut.cut_documents(df)) == [(i,) for i, *_ in cut_]
    rates = {r["source"]: (r["documents"], r["cut_documents"]) for r in cut.cut_rates(df).collect()}
    assert rates == {"s": (209, 0), "t": (6, 6), None: (1, 1)}
    assert cut.cut_documents(df.limit(0)).count() == 0


def test_copies_of_a_cut_text_do_not_vouch_for_each_other(spark):
    docs, _ = corpus()
    copies = [(500 + i, docs[2][1] + " The committee painted a" + " " * (i % 2), "t") for i in range(100)]
    df = spark.createDataFrame(docs + copies + [(700, docs[3][1] + " The committee painted a", "t")], "doc_id bigint, text string, source string")
    assert rows(cut.cut_documents(df)) == [(i,) for i in [*range(500, 600), 700]]
    assert {r["source"]: r["rate"] for r in cut.cut_rates(df).collect()} == {"s": 0.0, "t": 1.0}


def test_cut_texts_against_sql(spark):
    import duckdb

    docs, _ = corpus()
    rng = random.Random(4)
    data = [(i, t[: rng.randint(3, len(t))] if i % 3 == 0 else t) for i, t, _ in docs]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", data)
    assert rows(cut.cut_documents(df)) == sorted(con.execute(cut.oracle()).fetchall(), key=repr)
