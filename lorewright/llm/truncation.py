"""Texts that break off before their end.

Each text is read once by a stack automaton over its structure: brackets,
quotes and markup open and close on one stack, sentence ends and paragraphs
mark where the last sentence began.  A text is broken when it ends inside a
tag, an entity, an escape or a character, at a mark that sources put where
they cut, inside a bracket of its last sentence, or inside a quote or an
element.  Brackets that only an earlier sentence left open prove nothing, as
full texts are often careless with them; elements whose end tag may be left
out count only in texts that write it.

A missing terminator alone is weaker evidence: it counts unless the last line
is a list item or a closing line (keywords, reference, link, date, signature,
...), and unless nearly all texts of the source lack terminators, which is
the source's way of writing and not a loss.  Titles need no terminator; what
proves a break in a text proves it in a title too.  Unterminated texts that
fill a source's field, which many of its texts do to the character, were cut
by that limit whatever the source's way of writing.

Defined cases: NULL and blank texts are not truncated and do not count in a
source's total; a NULL source is a source of its own; repeated rows are judged
alike; texts are read whole whatever their length; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHOLE, CLOSING, LISTED, OPEN, BROKEN = "whole", "closing", "listed", "open", "broken"

_TOKEN = re.compile(r"""<(/?)([a-zA-Z][\w:-]*)(?:\s[^<>]*)?>|([(\[{)\]}"“”„«»])|([.!?…]+(["“”’«»)\]]*)(?=\s|$))|(\n\s*\n)|<!--.*?-->""", re.S)
#: What each sign closes; quotes that open in one language close in another.
_MATE = {")": "(", "]": "[", "}": "{", "”": "“„", "“": "„", "»": "«", "«": "»", '"': '"'}
_OPENS = set("([{“„«»\"")
_QUOTES = set("“„«»\"")
#: Elements whose end tag may be left out (fixed values).
_OPTIONAL_END = {"p", "li", "dt", "dd", "td", "th", "tr", "option", "body", "html", "thead", "tbody"}
_VOID = {"br", "hr", "img", "meta", "link", "input", "wbr"}
_BROKEN_END = re.compile(
    r"""<[/!]?[a-zA-Z][^<>]*$|<[/!]?$|&\#?\w{0,9}$|\\u[0-9a-fA-F]{0,3}$|\\x[0-9a-fA-F]?$|\\$|%[0-9A-F]?$|�\s*$|[Ã][\x80-\xbf]?$"""
)
_CUT_MARK = re.compile(
    r"""(?:\.\.\.|…|\[\s*(?:\.\.\.|…)\s*\]|\[cont\w*\.?\s*(?:\]|$)|\(\s*(?:more|continued|cont\.?|suite|mehr|weiter|m[aá]s|\.\.\.|…)\s*\)|\[\s*(?:more|truncated|continued|read more|gek[üu]rzt|suite|contin[uú]a)\s*\]|(?:\.\.\.|…)?\s*\b(?:[Rr]ead more|[Ww]eiterlesen|[Ll]ire la suite|[Ll]eer m[aá]s)\W*|>>|»»)\s*$"""
)
_LIST_ITEM = re.compile(r"^\s*(?:[-•*‣–]|\(?\d{1,3}[.)]|\(?[a-z][.)])\s+\S")
_CLOSING = re.compile(
    r"""\W*(?:
      (?:key\s?words?|schl[üu]ssel(?:w|b)\w*|schlagw\w*|stichw\w*|mots[ -]cl[ée]s?|palabras\s+clave|index\s+terms|jel|msc|pacs|doi|isbn|issn)\b\s*[:.]?.*
    | (?:subjects?|topics?|tags|url|source|quelle|fuente|contact|e-?mail)\s*[:.].*
    | (?:received|revised|accepted|submitted|published|eingegangen|angenommen|re[çc]u|accept[ée]|publi[ée]|recibido|aceptado|publicado|available\s+online|last\s+updated?|updated|printed)\b[^.]*\d\W*
    | n\s*=\s*\d.*\d\W*
    | (?:clinical\s+)?trial\s+(?:registration|no|number|id).*\d\W*
    | [^\W\d]['’\w-]+,?\s+(?-i:(?:[A-Z]\.?\s?){1,3})(?:,.*|et\s+al\.?)?\s*\(\d{4}[a-z]?\).*\d\W*
    | (?:https?://|www\.|doi:|10\.\d{4,}/)\S+
    | \S+@\S+\.\w+
    | (?:©|\(c\)|copyright|all\s+rights).*
    | [—–-]+\s*(?-i:[A-Z])[\w.]*(?:\s+[\w.'’-]+){0,4}(?:,\s*[\w\s]+)?
    | \d{1,2}[./-]\d{1,2}[./-]\d{2,4} | \d{4}-\d{2}-\d{2}
    | (?:table|figure|fig|tab|appendix)\.?\s*[\dA-Z]{1,4}\W*
    | (?:references|bibliography|acknowledge?ments?|literatur|danksagung|r[ée]f[ée]rences|referencias)\W*
    )$""",
    re.I | re.X,
)
_IN_PRESS = re.compile(r"\((?:in press|forthcoming|submitted|in preparation|im druck|im erscheinen|sous presse|à para[iî]tre|en prensa)\)\s*$", re.I)
_TAIL_TAGS = re.compile(r"(?:\s*</[a-zA-Z][\w:-]*\s*>|\s*<(?:br|hr)\s*/?>)+\s*$")
_ENDED = re.compile(r"""[.!?。！？]["'”“’»«)\]]*$""")
_ENTITY_CLOSE = re.compile(r"&(?:quot|rdquo|raquo|rsquo|nbsp);\s*$")
_OPEN_NUMBER = re.compile(r"(?:[=<>≈±]\s*|\b(?:to|of|at|by|de|à|von|auf|um|a|en)\s+)0[.,]$")


class Automaton:
    """The stack of what is open, where the last sentence began, and which elements were ever closed."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.open: Counter[str] = Counter()
        self.sentence = self.before = 0
        self.closed: set[str] = set()

    def push(self, symbol: str, at: int) -> None:
        self.stack.append((symbol, at))
        self.open[symbol] += 1

    def close(self, symbols: str | tuple[str, ...]) -> bool:
        """Close the innermost of these; what was opened within it goes with it."""
        if not any(self.open[s] for s in symbols):
            return False
        while True:
            s, _ = self.stack.pop()
            self.open[s] -= 1
            if s in symbols:
                return True

    def sign(self, c: str, text: str, at: int) -> None:
        if c == '"':  # a straight quote opens before a word and closes behind one
            if not self.close(c) and (at == 0 or not text[at - 1].isalnum()) and text[at + 1 : at + 2].strip():
                self.push(c, at)
        elif c in _MATE and self.close(_MATE[c]):
            return
        elif c in _OPENS:
            self.push(c, at)

    def read(self, text: str) -> None:
        for m in _TOKEN.finditer(text):
            slash, tag, sign, stop, behind, gap = m.groups()
            if tag:
                name = tag.lower()
                if slash:
                    self.closed.add(name)
                    self.close(("<" + name,))
                elif name not in _VOID and not m[0].endswith("/>"):
                    self.push("<" + name, m.start())
            elif sign:
                self.sign(sign, text, m.start())
            elif stop is not None:
                for k, c in enumerate(behind):
                    if c != "’":
                        self.sign(c, text, m.start(5) + k)
                self.before, self.sentence = self.sentence, m.end()
            elif gap and any(self.open[q] for q in _QUOTES):  # quotes that run on are opened anew in each paragraph
                self.stack = [x for x in self.stack if x[0] not in _QUOTES]
                self.open = Counter(s for s, _ in self.stack)

    def broken(self, ended: bool) -> bool:
        """Whether the text ends inside something.

        A full stop may stand inside a bracket.  Quotes and elements count
        wherever they were opened, brackets if the last sentence opened them.
        """
        for s, at in self.stack:
            if s[0] == "<":
                if s[1:] not in _OPTIONAL_END or s[1:] in self.closed:
                    return True
            elif s in _QUOTES or (not ended and at >= self.sentence):
                return True
        return False


def judge(text: str | None, title: bool = False) -> str | None:
    """How a text ends: whole, closing, listed, open (no terminator) or broken; None for blank text."""
    if text is None:
        return None
    t = text.rstrip()
    if not t:
        return None
    if _CUT_MARK.search(t) or _BROKEN_END.search(t):
        return BROKEN
    a = Automaton()
    a.read(t)
    body = _TAIL_TAGS.sub("", t)
    body = _ENTITY_CLOSE.sub("", body).rstrip()
    ended = bool(_ENDED.search(body))
    if a.broken(ended):
        return BROKEN
    if title:
        return LISTED
    if ended:
        # a full stop ends a sentence even within a bracket, but not within a number
        return BROKEN if _OPEN_NUMBER.search(body) else WHOLE
    line = body.rsplit("\n", 1)[-1]
    tail = body[a.sentence :] if a.sentence < len(body) else line
    for part in (line, tail, tail.lstrip('”"’») ')):
        if _CLOSING.match(re.sub(r"<[^<>]*>", " ", part).strip()):
            return CLOSING
    if _IN_PRESS.search(body):
        return CLOSING
    if _LIST_ITEM.match(line):
        return LISTED
    if any(_CLOSING.match(line, m.end()) for m in re.finditer(r"(?<=[.!?”)])\s+(?=\S)", line)):
        return CLOSING
    return OPEN


def endings(df: DataFrame, text: str = "text", kind: str | None = "doc_kind") -> DataFrame:
    """Every row with its ``ending``, the text's ``_length`` and ``_print``; columns of the input are carried along, the text itself is not."""
    keep = [c for c in df.columns if c not in (text, "ending", "_length", "_print")]
    flag = F.coalesce(F.col(f"`{kind}`") == "title", F.lit(False)) if kind and kind in df.columns else F.lit(False)

    @F.pandas_udf("string")
    def ending(texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for t, k in texts:
            yield pd.Series([judge(x, bool(y)) for x, y in zip(t, k)], dtype="object")

    return df.select(*[F.col(f"`{c}`") for c in keep], ending(F.col(f"`{text}`"), flag).alias("ending"), F.length(F.col(f"`{text}`")).alias("_length"), F.xxhash64(F.col(f"`{text}`")).alias("_print"))


def truncated(judged: DataFrame, source: str = "source", usual: float = 0.9, z: float = 1.64) -> DataFrame:
    """The judged rows with ``truncated``: broken ones, and open ones of sources that do write terminators.

    A source has no terminators to miss when its share of running texts
    without one is surely above ``usual``: the lower bound of that share (z
    standard deviations, Wilson) decides, so few cases never do.  A source has
    a field limit when its longest texts end without terminator and surely
    more different texts have just that length than the half just below it would
    let expect.  Both are small aggregates, partial per task.
    """
    running = F.col("ending").isin(OPEN, WHOLE)
    unended = F.col("ending").isin(OPEN, LISTED)
    j = judged.withColumn("_src", F.col(f"`{source}`"))
    base = j.groupBy("_src").agg(F.count(F.when(running, 1)).alias("_r"), F.count(F.when(F.col("ending") == OPEN, 1)).alias("_o"), F.max("_length").alias("_limit"))
    share = F.col("_o") / F.col("_r")
    spread = z * F.sqrt(share * (1 - share) / F.col("_r") + z * z / (4 * F.col("_r") * F.col("_r")))
    lower = (share + z * z / (2 * F.col("_r")) - spread) / (1 + z * z / F.col("_r"))
    known = base.select("_src", "_limit", F.coalesce(F.when(F.col("_r") > 0, lower > usual), F.lit(False)).alias("_unterminated"))
    # texts at the limit against those of the ten percent of lengths below it
    near = j.join(known.select(F.col("_src").alias("_s"), "_limit"), F.col("_src").eqNullSafe(F.col("_s"))).where(F.col("_length") > 0.9 * F.col("_limit"))
    spikes = near.groupBy("_s").agg(F.max("_limit").alias("_limit"), F.count_distinct(F.when((F.col("_length") == F.col("_limit")) & unended, F.col("_print"))).alias("_at"), F.count(F.when(F.col("_length") < F.col("_limit"), 1)).alias("_below"))
    each = F.col("_below") / F.greatest(F.lit(1.0), 0.1 * F.col("_limit"))
    spikes = spikes.where(F.col("_at") > 4 + 3 * each + 3 * F.sqrt(each)).select("_s", F.col("_limit").alias("_cut_at"))
    facts = known.join(spikes, F.col("_src").eqNullSafe(F.col("_s")), "left").select(F.col("_src").alias("_of"), "_unterminated", "_cut_at")
    j = j.join(facts, F.col("_src").eqNullSafe(F.col("_of")), "left")
    at_limit = F.coalesce(F.col("_length") == F.col("_cut_at"), F.lit(False))
    cut = (F.col("ending") == BROKEN) | ((F.col("ending") == OPEN) & ~F.col("_unterminated")) | (unended & at_limit)
    return j.withColumn("truncated", F.coalesce(cut, F.lit(False))).drop("_src", "_of", "_unterminated", "_cut_at", "_length", "_print")


def source_report(marked: DataFrame, source: str = "source") -> DataFrame:
    """Texts, truncated texts and their share per source."""
    r = marked.where("ending IS NOT NULL").groupBy(F.col(f"`{source}`").alias("source")).agg(F.count("*").alias("texts"), F.count(F.when(F.col("truncated"), 1)).alias("truncated_texts"))
    return r.withColumn("share", F.round(F.col("truncated_texts") / F.col("texts"), 4))
