"""Problem 3: rows whose page holds template residue, filler, an error message or a demand for scripts in place of content.

Method: normalised lines are counted by host and recurrent boilerplate is subtracted (the statistics of `content`);
a row is excluded if what is left of its page shows such evidence and hardly a sentence of real text.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from lodestrand.llm.content import pages_of, read_pages

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
SENTENCE = re.compile(r"[.!?。](?=\s|$)|\n")

# The usual forms of a template's placeholder.
PLACEHOLDER = re.compile(
    r"\{\{[^{}]*\}\}|\$\{[^{}]*\}|\{\$?[a-z_][\w.]*\}|\[\[[\w. ]+\]\]|\[%.*?%\]|<%.*?%>|&lt;%.*?%&gt;|%\([\w. ]+\)[sd]|%[A-Z_]{3,}%|__[A-Z_]{3,}__|@@[\w.]+@@|\?\?[\w. ]+\?\?|#[A-Z_]{3,}#"
    r"|</?tal:[^>]*>|<[a-z]+:[a-z_. ]+(?:\s[^>]*)?/?>|\{#[^{}]*#\}"
)
# The first letters of the words of the customary dummy text.
DUMMY = frozenset(
    """lore ipsu dolo sita amet ullam conse adipi elit sedd sedu eius temp inci labo magn aliq enim mini veni quis nost exer ulla nisi commo
    exea duis aute irur repr volu veli esse cill fugi null pari exce sint occa cupi proi sunt culp offi dese moll anim esto tame""".split()
)
DUMMY_LENGTHS = sorted({len(x) for x in DUMMY})
KEYS = frozenset("test foo bar baz bla blah asdf qwer qwerty aaa xxx tbd todo tba abc".split())  # fixed values: words typed to fill a field
FILLER = re.compile(
    r"^(?:lorem ipsum|untitled(?: page| document)?|page title|new page(?: \d+)?|heading \d+|title|sample page|hello world|your title here)\.?$"
    r"|\btodo:|\bheadline goes here|\bgoes here\b|\btext here\]|\[insert\b|do not publish|^add a (?:short )?(?:description|text|title)\b|^replace this\b|^click (?:edit|here) to (?:change|edit)\b|^coming soon|under construction"
)
# Standing phrases of error pages, by what they tell.
ERROR = re.compile(
    r"not found\b|page not found|internal server error|bad gateway|gateway time-?out|service (?:temporarily )?unavailable|bad request|forbidden\b|access denied|unauthori[sz]ed|permission to (?:view|access)"
    r"|an error (?:has )?occurred|site error|fatal error|server (?:met|encountered)|could not complete your request|database connection|did not answer within|traceback \(most recent|^file \".*line \d|\b\w{0,40}error: "
    r"|allowed memory|bytes exhausted|upstream host|invalid answer|session has expired|log in again|too many requests|rate limit|retry after|timed out|failed to load|cannot be displayed|refused by the server"
    r"|does not exist any ?more|no longer available|has gone\b|could not find|moved or deleted|is not on this server|status \d{3}\b|^\d{3}\b.*(?:error|not found|forbidden|unavailable)|^error \d|something went wrong|down for maintenance|be back shortly"
    r"|please quote \d|check the spelling|try a search|contact the webmaster|back to the start page|^(?:sorry|hmm|oops!?|notice)\.?$"
    r"|introuvable|n'existe pas|a été déplacée|accès (?:refusé|interdit)|erreur \d|erreur (?:interne|du serveur)|service indisponible|session a expiré"
    r"|seite nicht gefunden|nicht gefunden|nicht vorhanden|zugriff verweigert|fehler \d|keine berechtigung|interner (?:server)?fehler|ist ein fehler aufgetreten|sitzung ist abgelaufen"
    r"|no encontrad[ao]|no existe en|acceso (?:denegado|prohibido)|error interno|ha ocurrido un error|sesión ha (?:caducado|expirado)"
)
SCRIPTS = re.compile(
    r"(?:enable|activate|allow|turn on|switch on) (?:javascript|java script|scripts|scripting|cookies)|(?:javascript|scripts|scripting)(?: and cookies)? (?:must|is|are|needs? to) (?:be )?(?:allowed|required|enabled|disabled)|scripts? required|needs scripts"
    r"|blocks scripts|switch on scripting|checking your browser|^(?:one moment|loading\.*|please wait)\.*$"
    r"|javascript.*(?:aktivieren|einschalten|erforderlich)|aktivieren sie|skripte (?:aktivieren|erlauben)|activer (?:les scripts|javascript)|activez (?:les scripts|javascript)|active (?:los scripts|javascript)|habilit[ae] (?:los scripts|javascript)"
)
MOST_REAL = 1  # sentences of real text that may stand beside the evidence
REAL_WORDS = 6


def dummy(words: list[str]) -> bool:
    """Most of these words begin as words of the dummy text do, or are keys typed at random."""
    if not words:
        return False
    hit = sum(any(w[:n] in DUMMY for n in DUMMY_LENGTHS) for w in words)
    keys = sum(w in KEYS for w in words)
    return len(words) >= 4 and (hit >= 0.6 * len(words) or keys >= 0.4 * len(words))


def evidence(text: str) -> str | None:
    """What a line of text is evidence of: placeholder, filler, error or scripts."""
    low = text.lower()
    if PLACEHOLDER.search(text):
        return "placeholder"
    if FILLER.search(low) or dummy(WORD.findall(low)):
        return "filler"
    if SCRIPTS.search(low):
        return "scripts"
    if ERROR.search(low):
        return "error"
    return None


def residue(parts: list[tuple[str, str]]) -> str | None:
    """parts: (tag, text) of the lines of a page's own content. The kind of evidence that stands in its place, or None.

    Code is not evidence. A sentence with evidence in it counts neither as real text nor, on a page with more than
    MOST_REAL real sentences, against the page, so that pages about such things stay.
    """
    real, kinds, shown = 0, {}, False
    for tag, text in parts:
        if tag in ("pre", "code"):
            real += 1
            continue
        if tag[:1] != "h" and dummy(WORD.findall(text.lower())):
            kinds["filler"] = kinds.get("filler", 0) + 1
            continue
        whole = evidence(text)
        for s in SENTENCE.split(text):
            if not (s := s.strip()):
                continue
            if kind := evidence(s):
                kinds[kind] = kinds.get(kind, 0) + 1
                shown |= tag[:1] != "h"
            elif len(WORD.findall(s)) >= REAL_WORDS and tag[:1] != "h":
                real += 1
        if whole and not kinds:
            kinds[whole] = 1
        if real > MOST_REAL and not kinds.get("filler"):
            return None
    if not kinds or real > MOST_REAL:
        return None
    return max(sorted(kinds), key=kinds.get)


def _exclude(pages):
    last, ids, kinds = None, [], []
    out = lambda: pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kinds, pa.string())], ["item_id", "kind"])
    for batch, item, lines, keep in pages:
        if batch is not last and ids:
            yield out()
            ids, kinds = [], []
        last = batch
        if kind := residue([(x.tag, x.text) for x, k in zip(lines, keep, strict=True) if k]):
            ids.append(item)
            kinds.append(kind)
    if ids:
        yield out()


def residue_rows(items: DataFrame, *, item: str = "item_id", site: str = "site_url", text: str = "content_text") -> DataFrame:
    """(item_id, kind) of the rows to exclude; kind is placeholder, filler, error or scripts.

    Rows without text give none, nor do rows whose page has no content of its own. Repeated ids are judged each by
    themselves; other columns are ignored; an empty table gives an empty result.
    """
    return read_pages(pages_of(items, item, site, text), _exclude, "item_id bigint, kind string")
