"""The queries of this subpackage: name -> f(spark, sf_dir)."""

from __future__ import annotations

from lodestrand.llm import content, cut, lines, markup, mixing, neardup, residue, spam, tokens
from pyspark.sql import functions as F

from lodestrand.session import table


def p1_found(spark, d):
    return content.content_lines(table(spark, d, "items"))


def p3_found(spark, d):
    return residue.residue_rows(table(spark, d, "items")).select("item_id")


def p4_found(spark, d):
    return neardup.join_texts(table(spark, d, "items")).pairs().select(F.col("a").alias("item_id_a"), F.col("b").alias("item_id_b"))


def p4_groups(spark, d):
    return neardup.join_texts(table(spark, d, "items")).groups().withColumnRenamed("doc", "item_id")


def p5_found(spark, d):
    return markup.markup_languages(table(spark, d, "documents"))


def p5_clean(spark, d):
    return markup.clean_texts(table(spark, d, "documents"))


def p5_clean_html(spark, d):
    return markup.clean_texts(table(spark, d, "items"), doc="item_id", text="html_raw").withColumnRenamed("doc_id", "item_id")


def p6_found(spark, d):
    return spam.spam_pages(table(spark, d, "items"))


def p7_found(spark, d):
    return lines.repeated_lines(table(spark, d, "items"))


def p7_near(spark, d):
    return lines.repeated_lines(table(spark, d, "items"), near=True)


def p8_ids(spark, d):
    return tokens.token_ids(table(spark, d, "documents"))


def p9_copies(spark, d):
    return mixing.copies(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_shares(spark, d):
    targets = table(spark, d, "mix_targets")
    return mixing.shares(mixing.copies(table(spark, d, "documents"), targets), targets)


def p10_found(spark, d):
    return cut.cut_documents(table(spark, d, "documents"))


def p10_rates(spark, d):
    return cut.cut_rates(table(spark, d, "documents"))


NAMES = ("p1_found", "p3_found", "p4_found", "p4_groups", "p5_found", "p5_clean", "p5_clean_html", "p6_found", "p7_found", "p7_near", "p8_ids", "p9_copies", "p9_shares", "p10_found", "p10_rates")


def queries():
    return {name: globals()[name] for name in NAMES}


def oracle_sql():
    found = cut.oracle()
    rates = f"""WITH cut AS ({found}) SELECT d.source, count(*) AS documents, count(cut.doc_id) AS cut_documents, count(cut.doc_id) / count(*) AS rate
        FROM documents d LEFT JOIN cut ON cut.doc_id = d.doc_id GROUP BY d.source"""
    return {"p10_found": found, "p10_rates": rates}
