"""Problem 10: texts cut off by a field's limit or in transfer, and how often each source cuts.

Method, in pure SQL: word trigrams are counted inside texts (another word or a sign follows on the line) and at ends (the
line ends there) over the whole corpus; the final trigram of every text is joined to the counts, and texts are flagged
whose final trigram is frequent inside but almost never at an end. Its last word may be the beginning of a longer word,
so a text cut inside a word is found by the trigrams that its last word begins. Names count as one word, numbers as
another. Where a trigram is too rare to tell, and to keep headings apart, the same is done with four tokens of which
only function words are told apart. Texts that end in a mark of the cut, in half a character or inside a tag are cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrand.llm.spam import FUNCTION
from lodestrand.session import materialise

# More words that build sentences and headings rather than name things.
MORE = (
    "about how why what where after before until because although though between during over under once also nobody every each its their our your we you they he she will would can could may must should one here today "
    "sobre cómo qué donde después antes aunque entre cada su nuestro vous nous ils comment pourquoi où après avant bien chaque leur notre puis wie warum wo nach vor obwohl zwischen jede jeder jedes ihre unser sobald mehr"
)
WORDS = sorted(FUNCTION | set(MORE.split()))
NAME = "\ue000"  # stands for a capitalised word that does not begin a line or sentence
MARK = r"(\[(more|\.\.\.|…)\]|\((cont|continued|more)\.*\)?|…|\.\.\.|\x{FFFD}+)$"
MARK_CHARS = 40  # no mark is longer
IN_TAG = r"^(/?[a-zA-Z][^<>]*|!-*[^<>]*)?$"  # of what follows the last '<'
WHOLE = """'.', '!', '?', '。', '”', '"', '»', ')', ']', '}', '>'"""
# A trigram tells if it is inside so often; it is almost never at an end if so many times rarer there.
FEW, RARER, STRONG, STRONGER = 3, 50, 100, 100
COARSE, COARSE_RARER = 20, 100
WORD_BITS = 19  # the bitmap of final keys has 2 ** 19 words of 64 bits: 4 MB


def _flag(i3: str, t3: str, i4: str, t4: str) -> str:
    return (
        f"({i3} >= {STRONG} AND {t3} * {STRONGER} <= {i3}) OR ({i3} >= {FEW} AND {t3} * {RARER} <= {i3} AND NOT ({t4} >= 2 AND {t4} * {RARER} > {i4}))"
        f" OR ({i4} >= {COARSE} AND {t4} * {COARSE_RARER} <= {i4})"
    )


def _coarse(x: str) -> str:
    """What is told apart of a token in the long gram: function words and signs. A word of one letter differs by case."""
    return f"CASE WHEN {x} IN ({', '.join(repr(w) for w in WORDS)}) THEN {x} WHEN octet_length({x}) > 4 OR upper({x}) <> {x} THEN 'w' ELSE {x} END"


def _escaped(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def _tokens(texts: str) -> str:
    """(doc_id, t, w): the tokens of each text in Spark's SQL, two line ends before them and one after."""
    # The capital is looked for first: what stands before it is tested at capitals only.
    name = r"\p{Lu}(?<=(?:[\p{L}\p{N},;:] |[\"“(])\p{Lu})[\p{L}\p{M}]*"
    mask = f"lower(regexp_replace(regexp_replace(t, '{_escaped(name)}', '{NAME}'), '{_escaped(chr(92) + "p{N}+")}', '0'))"
    token = r"[\p{L}\p{M}]+|\n|[^\s\p{L}\p{M}]"
    return f"SELECT doc_id, t, concat(array('\\n', '\\n'), regexp_extract_all({mask}, '{_escaped(token)}', 0), array('\\n')) AS w FROM ({texts})"


def _texts(documents: str) -> str:
    """(doc_id, t): texts without white space at their end, a line end as one sign. Texts whose line ends are so already skip the pattern."""
    odd = " OR ".join(f"contains(t, '{x}')" for x in (r"\r", r"\n\n", r"\n ", r"\n\t", r"\n\u000b", r"\n\f"))
    ends = f"CASE WHEN {odd} THEN regexp_replace(t, '{_escaped(chr(91) + chr(92) + 'r' + chr(92) + 'n]' + chr(92) + 's*')}', '\\n') ELSE t END"
    return f"SELECT doc_id, {ends} AS t FROM (SELECT doc_id, rtrim(' \\t\\n\\r\\f\\u00a0\\ufeff', text) AS t FROM {documents} WHERE text IS NOT NULL) WHERE t <> ''"


def _prepared_sql(texts: str) -> str:
    """(doc_id, marked, open, w, c): each text cut into tokens once, with the coarse form of each token. marked: the text
    ends in a mark of the cut or in a tag; open: it does not end as whole texts do."""
    marked = f"right(t, {MARK_CHARS}) RLIKE '{_escaped(MARK)}' OR (instr(t, '<') > 0 AND substring_index(t, '<', -1) RLIKE '{IN_TAG}')"
    tokens = _tokens(f"SELECT *, {marked} AS marked FROM {texts}").replace("SELECT doc_id, t,", f"SELECT doc_id, marked, marked OR right(t, 1) NOT IN ({WHOLE}) AS open,", 1)
    return f"SELECT *, transform(w, x -> {_coarse('x')}) AS c FROM ({tokens})"


def _finals_sql(prepared: str) -> str:
    """The last grams of each text that is open: k3 and k4 are the tokens before the last one, d and d4 the last."""
    at = lambda name, i: f"element_at({name}, {i})"
    k3, k4 = f"xxhash64({at('w', -4)}, {at('w', -3)})", f"xxhash64({at('c', -5)}, {at('c', -4)}, {at('c', -3)})"
    last = f"SELECT doc_id, marked, {k3} AS k3, {k4} AS k4, {at('w', -2)} AS d, {at('c', -2)} AS d4 FROM {prepared} WHERE open AND size(w) >= 6"
    return f"SELECT *, octet_length(d) > 4 OR upper(d) <> d AS word FROM ({last})"


def _bits_sql(finals: str, k: str) -> str:
    """A bitmap of the keys k, 64 to a row: at most 2 ** WORD_BITS rows at any size of the corpus."""
    return f"SELECT {_word(k)} AS word, bit_or(shiftleft(1L, {_bit(k)})) AS mask FROM {finals} WHERE NOT marked GROUP BY 1"


def _word(k: str) -> str:
    return f"shiftrightunsigned({k}, {64 - WORD_BITS})"


def _bit(k: str) -> str:
    return f"cast(shiftrightunsigned({k}, {58 - WORD_BITS}) & 63 AS int)"


def _counts_sql(prepared: str, finals: str) -> str:
    """(kind, k, d, inside, ends): how often token d follows the grams k inside a line and at its end, over all texts.

    Asked for are only the grams of final keys. A bitmap of these keys screens the tokens where they stand, before two
    rows are made of one; what passes it by chance is counted too and joins nothing later, so it costs no row.
    """
    at = lambda name, i: f"get({name}, i + {i})"
    grams = f"""SELECT xxhash64({at('w', 1)}, {at('w', 2)}) AS k3, xxhash64({at('c', 0)}, {at('c', 1)}, {at('c', 2)}) AS k4, {at('w', 3)} AS d, {at('c', 3)} AS d4, {at('w', 4)} <> '\n' AS inside
        FROM (SELECT w, c, explode(sequence(0, size(w) - 5)) AS i FROM {prepared} WHERE size(w) >= 6) WHERE {at('w', 3)} <> '\n'"""
    hit = lambda t, k: f"coalesce(getbit({t}.mask, {_bit('g.' + k)}) = 1, false)"
    return f"""
WITH hits AS (
    SELECT /*+ BROADCAST(x, y) */ g.*, {hit('x', 'k3')} AS hit3, {hit('y', 'k4')} AS hit4 FROM ({grams}) g
    LEFT JOIN ({_bits_sql(finals, 'k3')}) x ON x.word = {_word('g.k3')} LEFT JOIN ({_bits_sql(finals, 'k4')}) y ON y.word = {_word('g.k4')}
), keyed AS (
    SELECT inside, inline(array(named_struct('hit', hit3, 'kind', 3, 'k', k3, 'd', d), named_struct('hit', hit4, 'kind', 4, 'k', k4, 'd', d4))) FROM hits WHERE hit3 OR hit4
)
SELECT kind, k, d, count_if(inside) AS inside, count_if(NOT inside) AS ends FROM keyed WHERE hit GROUP BY kind, k, d"""


def _found_sql(finals: str, counts: str) -> str:
    return f"""
WITH open3 AS (
    SELECT f.k3, f.d, sum(c.inside) AS inside, sum(CASE WHEN c.d = f.d THEN c.ends ELSE 0 END) AS ends
    FROM (SELECT DISTINCT k3, d, word, left(d, 1) AS first FROM {finals} WHERE NOT marked) f
    JOIN (SELECT k, d, inside, ends, left(d, 1) AS first FROM {counts} WHERE kind = 3) c ON c.k = f.k3 AND c.first = f.first AND (c.d = f.d OR (f.word AND startswith(c.d, f.d))) GROUP BY f.k3, f.d
), open4 AS (
    SELECT f.k4, f.d, sum(c.inside) AS inside, sum(CASE WHEN c.d = f.d4 THEN c.ends ELSE 0 END) AS ends
    FROM (SELECT DISTINCT k4, d, d4, word FROM {finals} WHERE NOT marked) f
    JOIN (SELECT k, d, inside, ends FROM {counts} WHERE kind = 4) c ON c.k = f.k4 AND (c.d = f.d4 OR (f.word AND startswith(c.d, f.d))) GROUP BY f.k4, f.d
)
SELECT f.doc_id FROM {finals} f LEFT JOIN open3 x ON x.k3 = f.k3 AND x.d = f.d LEFT JOIN open4 y ON y.k4 = f.k4 AND y.d = f.d
WHERE f.marked OR {_flag('coalesce(x.inside, 0)', '(coalesce(x.ends, 1) - 1)', 'coalesce(y.inside, 0)', '(coalesce(y.ends, 1) - 1)')}
"""


def cut_documents(documents: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id) of the documents whose text ends before its author ended.

    NULL, empty and blank texts, and texts of fewer than three tokens without a mark, are none. Repeated ids are judged
    each by themselves; other columns are ignored; an empty table gives an empty result. Equal texts count once, so that
    copies of a cut text do not vouch for each other; the verdict on a text goes to all its ids.
    """
    spark, view = documents.sparkSession, "lodestrand_cut_documents"
    documents.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).createOrReplaceTempView("lodestrand_cut_rows")
    # Equal but for white space at the end and the kind of line ends; the digest stands for the id of a text.
    rows = spark.sql(_texts("lodestrand_cut_rows")).select("doc_id", F.unhex(F.md5("t")).alias("text_id"), "t")
    texts = rows.groupBy("text_id").agg(F.min("t").alias("t")).withColumnRenamed("text_id", "doc_id")
    texts.createOrReplaceTempView("lodestrand_cut_texts")
    # All three are read more than once: written, so that each text is cut into tokens once.
    materialise(spark.sql(_prepared_sql("lodestrand_cut_texts")), "p10-tokens").createOrReplaceTempView(view)
    materialise(spark.sql(_finals_sql(view)), "p10-finals").createOrReplaceTempView("lodestrand_cut_finals")
    materialise(spark.sql(_counts_sql(view, "lodestrand_cut_finals")), "p10-counts").createOrReplaceTempView("lodestrand_cut_counts")
    found = spark.sql(_found_sql("lodestrand_cut_finals", "lodestrand_cut_counts")).select(F.col("doc_id").alias("text_id"))
    return rows.select("doc_id", "text_id").join(found, "text_id", "left_semi").select("doc_id")


def cut_rates(documents: DataFrame, *, doc: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(source, documents, cut_documents, rate) for each source, NULL included. Ids must be unique here."""
    cut = cut_documents(documents, doc=doc, text=text).select(F.col("doc_id").alias("__doc"), F.lit(1).alias("__cut"))
    rows = documents.select(F.col(doc).cast("bigint").alias("__id"), F.col(source).alias("source"))
    joined = rows.join(cut, rows["__id"] == cut["__doc"], "left")
    return joined.groupBy("source").agg(F.count("*").alias("documents"), F.count("__cut").alias("cut_documents")).withColumn("rate", F.col("cut_documents") / F.col("documents"))


def oracle() -> str:
    """The same in DuckDB's SQL, where every row counts: it differs only where copies vouch for a cut text."""
    coarse = lambda x: _coarse(x).replace("octet_length(", "strlen(")
    cap = r"""([\p{L}\p{N}\x{E000},;:] |["“(])\p{Lu}[\p{L}\p{M}]*"""
    mask = f"lower(regexp_replace(regexp_replace(regexp_replace(t, '{cap}', '\\1{NAME}', 'g'), '{cap}', '\\1{NAME}', 'g'), '\\p{{N}}+', '0', 'g'))"
    nl = "chr(10)"
    return f"""
WITH texts AS (
    SELECT doc_id, text, regexp_replace(rtrim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(160) || chr(65279)), '[\\r\\n]\\s*', {nl}, 'g') AS t FROM documents WHERE text IS NOT NULL
), tokens AS (
    SELECT doc_id, t, list_concat([{nl}, {nl}], list_concat(regexp_extract_all({mask}, '[\\p{{L}}\\p{{M}}]+|\\n|[^\\s\\p{{L}}\\p{{M}}]'), [{nl}])) AS w FROM texts WHERE t <> ''
), grams AS (
    SELECT unnest(w[1:len(w) - 4]) AS a, unnest(w[2:len(w) - 3]) AS b, unnest(w[3:len(w) - 2]) AS c, unnest(w[4:len(w) - 1]) AS d, unnest(w[5:len(w)]) AS e FROM tokens WHERE len(w) >= 6
), c3 AS (
    SELECT b, c, d, sum(CASE WHEN e = {nl} THEN 0 ELSE 1 END) AS inside, sum(CASE WHEN e = {nl} THEN 1 ELSE 0 END) AS ends FROM grams WHERE d <> {nl} GROUP BY b, c, d
), c4 AS (
    SELECT {coarse('a')} AS a, {coarse('b')} AS b, {coarse('c')} AS c, {coarse('d')} AS d, sum(CASE WHEN e = {nl} THEN 0 ELSE 1 END) AS inside, sum(CASE WHEN e = {nl} THEN 1 ELSE 0 END) AS ends FROM grams WHERE d <> {nl} GROUP BY 1, 2, 3, 4
), finals AS (
    SELECT *, {coarse('a')} AS a4, {coarse('b')} AS b4, {coarse('c')} AS c4, {coarse('d')} AS d4, strlen(d) > 4 OR upper(d) <> d AS word
    FROM (SELECT doc_id, regexp_matches(right(t, {MARK_CHARS}), '{MARK}') OR (contains(t, '<') AND regexp_matches(string_split(t, '<')[-1], '{IN_TAG}')) AS marked, w[-5] AS a, w[-4] AS b, w[-3] AS c, w[-2] AS d FROM tokens WHERE len(w) >= 6)
    WHERE marked OR d NOT IN ({WHOLE})
), open3 AS (
    SELECT f.b, f.c, f.d, sum(c3.inside) AS inside, sum(CASE WHEN c3.d = f.d THEN c3.ends ELSE 0 END) AS ends
    FROM (SELECT DISTINCT b, c, d, word FROM finals WHERE NOT marked) f JOIN c3 ON c3.b = f.b AND c3.c = f.c AND (c3.d = f.d OR (f.word AND starts_with(c3.d, f.d))) GROUP BY f.b, f.c, f.d
), open4 AS (
    SELECT f.a4, f.b4, f.c4, f.d, sum(c4.inside) AS inside, sum(CASE WHEN c4.d = f.d4 THEN c4.ends ELSE 0 END) AS ends
    FROM (SELECT DISTINCT a4, b4, c4, d, d4, word FROM finals WHERE NOT marked) f JOIN c4 ON c4.a = f.a4 AND c4.b = f.b4 AND c4.c = f.c4 AND (c4.d = f.d4 OR (f.word AND starts_with(c4.d, f.d))) GROUP BY f.a4, f.b4, f.c4, f.d
)
SELECT f.doc_id FROM finals f LEFT JOIN open3 x ON x.b = f.b AND x.c = f.c AND x.d = f.d LEFT JOIN open4 y ON y.a4 = f.a4 AND y.b4 = f.b4 AND y.c4 = f.c4 AND y.d = f.d
WHERE f.marked OR {_flag('coalesce(x.inside, 0)', '(coalesce(x.ends, 1) - 1)', 'coalesce(y.inside, 0)', '(coalesce(y.ends, 1) - 1)')}
"""
