"""Whether two titles say the same words apart from writing and slips."""

from __future__ import annotations

import html
import re
import unicodedata

from lorewright.llm.names import slips

_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
#: Damaged remains of common entities (fixed values).
_ENTITY = re.compile(r"&?\b(?:quot|quo|qut|uot|qot|amp|nbsp|ldquo|rdquo|lt|gt);|&(?:quot|amp|nbsp|lt|gt)\b", re.I)
#: Words that a sign may stand for (fixed values).
CONNECTORS = {"and", "und", "et", "y", "e"}
_ROMAN = re.compile(r"[ivxlcdm]+")


def title_words(text: str | None) -> list[str]:
    """Folded words without markup, entities, punctuation and connectors."""
    if not text:
        return []
    t = _ENTITY.sub(" ", _TAG.sub(" ", html.unescape(html.unescape(text))))
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).casefold()
    return [w for w in re.findall(r"[^\W_]+", t) if w not in CONNECTORS]


def _ordinal(w: str) -> bool:
    """Numbers and Roman numerals tell parts of a series apart."""
    return any(c.isdigit() for c in w) or bool(_ROMAN.fullmatch(w))


def same_word(a: str, b: str) -> bool:
    """Equal, or one slip apart; two slips from eight letters on."""
    if a == b:
        return True
    if _ordinal(a) or _ordinal(b):
        return False
    most = 2 if min(len(a), len(b)) >= 8 else 1
    return slips(a, b, most) <= most


def most_changed(n: int) -> int:
    """Of n words so many may hold slips: every third, one always, two from four words on."""
    return max(2 if n >= 4 else 1, n // 3)


def same_title(a: list[str], b: list[str]) -> bool:
    """The same words in the same order, of which ``most_changed`` may hold slips.

    Words that were split or joined are accepted where the letters agree.
    """
    if not a or not b:
        return False
    if len(a) == len(b):
        changed = sum(x != y for x, y in zip(a, b))
        return changed <= most_changed(len(a)) and all(same_word(x, y) for x, y in zip(a, b))
    if abs(len(a) - len(b)) > 1:
        return False
    odd = set(a) ^ set(b)
    return not any(_ordinal(w) for w in odd) and slips("".join(a), "".join(b), 1) <= 1
