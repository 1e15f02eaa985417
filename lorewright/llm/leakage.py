"""Evaluation texts that stand in training texts.

The corpus is cut into shards; each shard orders its suffixes into a suffix
array over words, and every suffix of every test item is looked up in it by
binary search.  The verbatim matches found there are taken to their full
length on both sides.  A document is affected when its longest verbatim match
with an item has ``min_words`` words.  Where words were altered, matches are
carried on by a banded alignment that tolerates altered, missing and extra
words, and the document is affected when at least ``min_words`` successive
words of the item are there, of which ``min_share`` are verbatim, in one piece
or in two that one interruption separates.

Words compare without letter case, accents, punctuation, markup and line
breaks.  A suffix that begins with a word of no item can match no test suffix
and is left out of the array; the others are ordered as deep as the longest
item is long, so the array is complete for the search.

Size bound: the items are the broadcast side.  They are taken in blocks of at
most ``block_words`` words, one pass over the corpus each; a block's matches
are written before the next block is fetched, so the driver and the workers
hold one block at a time, whatever the number of items.

A closing sentence that many items share (a question or instruction) is no
part of an item's passage; what is shared is counted over all items before
they are cut into blocks.  Defined cases: NULL and empty texts match nothing;
items shorter than ``min_words`` are never found; repeated documents are each
reported; items with equal texts are each reported; an empty corpus or item
table gives an empty result; texts are read whole.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.session import empty, materialize

_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>")
_BROKEN_WORD = re.compile(r"(?<=\w)[-­‐]\s*\n\s*(?=\w)")
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")

RESULT = "doc_id bigint, item_id bigint, matched int, span int, item_from int, doc_from int"


def words(text: str | None) -> list[str]:
    """The words of a text as they are compared."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "\n" in text or "­" in text:
        text = _BROKEN_WORD.sub("", text).replace("­", "")
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return _WORD.findall(text.casefold())


def _closing(text: str | None) -> tuple[list[str], str]:
    """The sentences of an item, and the words of its last one if there are others."""
    sentences = _SENTENCE.split((text or "").strip())
    return sentences, " ".join(words(sentences[-1])) if len(sentences) > 1 else ""


def shared_closings(items: DataFrame, text: str = "text", least: int = 3, share: float = 0.01) -> frozenset[str]:
    """Closing sentences that at least ``least`` items and this share of all have; at most 1 / share of them."""

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"closing": [_closing(t)[1] for t in b["t"]]})

    n = items.select(F.col(f"`{text}`").alias("t")).mapInPandas(ends, "closing string").groupBy("closing").agg(F.count("*").alias("n"))
    total = n.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"))
    return frozenset(r[0] for r in n.where((F.col("closing") != "") & (F.col("n") >= least) & (F.col("n") >= F.lit(share) * total.scalar())).select("closing").collect())


def passage(text: str | None, shared: frozenset[str]) -> list[str]:
    """An item's words without a shared closing sentence."""
    sentences, closing = _closing(text)
    return words(" ".join(sentences[:-1] if closing in shared else sentences))


@dataclass
class ItemIndex:
    """Test items as word numbers: one array with separators, and where each item begins."""

    ids: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    flat: np.ndarray
    vocabulary: dict[str, int]

    @classmethod
    def build(cls, items: list[tuple[int, list[str]]]) -> ItemIndex:
        vocabulary: dict[str, int] = {}
        flat: list[int] = []
        starts, lengths = [], []
        for _, ws in items:
            starts.append(len(flat))
            lengths.append(len(ws))
            flat += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in ws] + [0] * 8
        return cls(np.array([i for i, _ in items], np.int64), np.array(starts, np.int64), np.array(lengths, np.int64), np.array(flat, np.int64), vocabulary)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of known words (above 0) of ``text``, ordered by the words that follow, to ``depth`` words at least.

    Prefix doubling: two suffixes that agree in k words are told apart by what
    is known of the suffixes k words on; only those still tied are sorted again.
    """
    order = np.flatnonzero(text > 0)
    order = order[np.argsort(text[order], kind="stable")]
    rank = np.zeros(len(text) + 1, np.int64)  # 0 for unknown words and the end
    first = np.concatenate([[True], text[order][1:] != text[order][:-1]]) if len(order) else np.empty(0, bool)
    place = np.arange(len(order))
    rank[order] = np.maximum.accumulate(np.where(first, place, 0)) + 1
    k, at = 1, place
    while k < depth and len(at):
        tied = rank[order[at]]
        again = np.concatenate([[False], tied[1:] == tied[:-1]])
        at = at[again | np.concatenate([again[1:], [False]])]
        if not len(at):
            break
        p = order[at]
        key = rank[p] * (len(text) + 1) + rank[np.minimum(p + k, len(text))]
        by = np.argsort(key, kind="stable")
        order[at], key = p[by], key[by]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[at]] = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))] + 1
        k *= 2
    return order


def _equal_range(text: np.ndarray, order: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row of ``suffix`` the range of the suffix array that begins with its words, by binary search."""
    lo = np.zeros(len(suffix), np.int64)
    hi = np.full(len(suffix), len(order), np.int64)
    last = len(text) - 1
    for k in range(suffix.shape[1]):  # the range of k words holds that of k+1
        want = suffix[:, k]
        bounds = []
        for right in (False, True):
            a, b = lo.copy(), hi.copy()
            while (open_ := a < b).any():
                mid = (a + b) // 2
                seen = text[np.minimum(order[np.minimum(mid, len(order) - 1)] + k, last)]
                up = open_ & ((seen <= want) if right else (seen < want))
                a = np.where(up, mid + 1, a)
                b = np.where(open_ & ~up, mid, b)
            bounds.append(a)
        lo, hi = bounds
    return lo, hi


def _verbatim(text: np.ndarray, item: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """How many words from (p, q) on are equal."""
    length = np.zeros(len(p), np.int64)
    alive = np.arange(len(p))
    while len(alive):
        n = length[alive]
        w = item[q[alive] + n]  # separators end every item
        alive = alive[(w > 0) & (text[np.minimum(p[alive] + n, len(text) - 1)] == w)]
        length[alive] += 1
    return length


def _extend(text: np.ndarray, item: np.ndarray, p: np.ndarray, q: np.ndarray, step: int, penalty: float, band: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best banded alignment from (p, q) on, forwards or backwards: matches, item words, document words."""
    n, width = len(p), 2 * band + 1
    low = -1e9
    score = np.full((n, width), low)
    score[:, band] = 0.0
    for k in range(band + 1, width):
        score[:, k] = score[:, k - 1] - penalty
    hits = np.zeros((n, width), np.int32)
    best, best_hits = np.zeros(n), np.zeros(n, np.int32)
    best_q, best_p = np.zeros(n, np.int32), np.zeros(n, np.int32)
    alive = np.arange(n)
    shift = np.arange(width) - band
    i = 0
    while len(alive):
        iq = q[alive] + step * i
        w = np.where((iq >= 0) & (iq < len(item)), item[np.clip(iq, 0, len(item) - 1)], 0)
        keep = w > 0
        alive, score, hits, w = alive[keep], score[keep], hits[keep], w[keep]
        if not len(alive):
            break
        jp = p[alive][:, None] + step * (i + shift)
        seen = text[np.clip(jp, 0, len(text) - 1)]
        same = (seen == w[:, None]) & (jp >= 0) & (jp < len(text)) & ((i + shift) >= 0)
        diag = score + np.where(same, 1.0, -penalty)
        new_hits = hits + same
        skip = np.concatenate([score[:, 1:], np.full((len(alive), 1), low)], axis=1) - penalty
        skip_hits = np.concatenate([hits[:, 1:], np.zeros((len(alive), 1), np.int32)], axis=1)
        better = skip > diag
        score, hits = np.where(better, skip, diag), np.where(better, skip_hits, new_hits)
        for k in range(1, width):
            better = score[:, k - 1] - penalty > score[:, k]
            score[:, k] = np.where(better, score[:, k - 1] - penalty, score[:, k])
            hits[:, k] = np.where(better, hits[:, k - 1], hits[:, k])
        i += 1
        top = score.argmax(axis=1)
        rows = np.arange(len(alive))
        value = score[rows, top]
        more = value > best[alive]
        at = alive[more]
        best[at], best_hits[at] = value[more], hits[rows, top][more]
        best_q[at], best_p[at] = i, i + shift[top[more]]
        going = value > best[alive] - 4 * penalty
        alive, score, hits = alive[going], score[going], hits[going]
    return best_hits, best_q, best_p


@dataclass(frozen=True)
class Rule:
    min_words: int = 18
    min_share: float = 0.88
    seed: int = 6
    interruption: int = 80
    penalty: float = 2.5


def find_in_shard(index: ItemIndex, docs: list[tuple[int, list[str]]], rule: Rule) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of ``RESULT`` for one shard of documents."""
    get = index.vocabulary.get
    sizes = np.array([len(ws) for _, ws in docs], np.int64)
    gap = 64
    starts = np.concatenate([[0], np.cumsum(sizes + gap)[:-1]]) + gap if len(docs) else np.empty(0, np.int64)
    text = np.full(int((sizes + gap).sum()) + gap, -1, np.int64)
    for s, (_, ws) in zip(starts, docs):
        text[s : s + len(ws)] = [get(w, -1) for w in ws]
    order = suffix_array(text, int(index.lengths.max(initial=0)))
    if not len(order):
        return []
    # every suffix of every item with at least `seed` words left
    owner = np.repeat(np.arange(len(index.ids)), np.maximum(index.lengths - rule.seed + 1, 0))
    first = np.concatenate([np.arange(max(n - rule.seed + 1, 0)) for n in index.lengths]) if len(owner) else np.empty(0, np.int64)
    q_all = index.starts[owner] + first
    lo, hi = _equal_range(text, order, index.flat[q_all[:, None] + np.arange(rule.seed)])
    count = hi - lo
    q = np.repeat(q_all, count)
    if not len(q):
        return []
    own = np.repeat(owner, count)
    p = order[np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    # left-maximal matches only: the others lie within them
    before_q = np.where(q > index.starts[own], index.flat[np.maximum(q - 1, 0)], 0)
    first_of = text[p - 1] != before_q
    q, p, own = q[first_of], p[first_of], own[first_of]
    verbatim = _verbatim(text, index.flat, p, q)
    right = _extend(text, index.flat, p, q, 1, rule.penalty)
    # going left must stop at the item's first word: the separators before it are zero
    left = _extend(text, index.flat, p - 1, q - 1, -1, rule.penalty)
    matched, span = right[0] + left[0], right[1] + left[1]
    q0, p0 = q - left[1], p - left[2]
    p1 = p + right[2]
    doc = np.searchsorted(starts, p, side="right") - 1
    blocks: dict[tuple[int, int], set[tuple[int, int, int, int, int]]] = {}
    longest: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for d, o, m, s, a, b, c, v, x, y in zip(doc.tolist(), own.tolist(), matched.tolist(), span.tolist(), (q0 - index.starts[own]).tolist(), p0.tolist(), p1.tolist(), verbatim.tolist(), (q - index.starts[own]).tolist(), p.tolist()):
        blocks.setdefault((d, o), set()).add((a, b, c, m, s))
        longest[(d, o)] = max(longest.get((d, o), (0, 0, 0, 0)), (v, v, x, y))
    out = []
    for (d, o), found in blocks.items():
        hit = _decide(sorted(found), rule)
        if longest[(d, o)][0] >= rule.min_words:
            hit = max(hit or longest[(d, o)], longest[(d, o)])
        if hit:
            m, s, a, b = hit
            out.append((docs[d][0], int(index.ids[o]), m, s, a, b - int(starts[d])))
    return out


def _decide(found: list[tuple[int, int, int, int, int]], rule: Rule) -> tuple[int, int, int, int] | None:
    """The best block, or pair of blocks around one interruption, that meets the rule: matched, span, item and text position."""
    good = lambda m, s: s >= rule.min_words and m >= rule.min_share * s
    singles = [(m, s, a, b) for a, b, _, m, s in found if good(m, s)]
    if singles:
        return max(singles)
    pairs = [
        (m1 + m2, s1 + s2, a1, b1)
        for a1, b1, c1, m1, s1 in found
        for a2, b2, _, m2, s2 in found
        if m1 >= rule.seed and m2 >= rule.seed and -1 <= a2 - (a1 + s1) <= 2 and 0 <= b2 - c1 <= rule.interruption and good(m1 + m2, s1 + s2)
    ]
    return max(pairs) if pairs else None


_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("matched", pa.int32()), ("span", pa.int32()), ("item_from", pa.int32()), ("doc_from", pa.int32())])


def _search(batches: Iterable[pa.RecordBatch], index: ItemIndex, rule: Rule, shard_words: int) -> Iterator[pa.RecordBatch]:
    def emit(shard: list[tuple[int, list[str]]]) -> pa.RecordBatch:
        rows = find_in_shard(index, shard, rule)
        columns = list(zip(*rows)) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _ARROW)], schema=_ARROW)

    shard: list[tuple[int, list[str]]] = []
    size = 0
    for batch in batches:
        for i, t in zip(batch.column(0), batch.column(1)):
            ws = words(t.as_py())
            if len(ws) >= rule.seed:
                shard.append((i.as_py(), ws))
                size += len(ws)
            if size >= shard_words:
                yield emit(shard)
                shard, size = [], 0
    if shard:
        yield emit(shard)


def item_blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> list[DataFrame]:
    """The items, cut into blocks of about ``block_words`` words by a hash of their id."""
    size = items.agg(F.sum(F.length(F.col(f"`{text}`"))).alias("n")).first()["n"] or 0
    n = max(1, -(-int(size) // (6 * block_words)))
    if n == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64(F.col(f"`{item_id}`")), F.lit(n)) == k) for k in range(n)]


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", rule: Rule | None = None, block_words: int = 2_000_000, shard_words: int = 400_000) -> DataFrame:
    """``doc_id, item_id`` with the words matched, the span and where it begins in item and document."""
    r = rule or Rule()
    corpus = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL AND doc_id IS NOT NULL")
    shared = shared_closings(items, text)
    context = docs.sparkSession.sparkContext
    out = empty(docs.sparkSession, RESULT)
    for block in item_blocks(items, item_id, text, block_words):
        rows = block.select(F.col(f"`{item_id}`").cast("bigint"), F.col(f"`{text}`")).where(F.col(f"`{item_id}`").isNotNull()).collect()
        held = context.broadcast(ItemIndex.build([(i, ws) for i, ws in ((x[0], passage(x[1], shared)) for x in rows) if len(ws) >= r.min_words]))
        out = out.unionByName(materialize(corpus.mapInArrow(lambda batches, held=held: _search(batches, held.value, r, shard_words), RESULT), "leaks"))
        held.destroy()
    return out


def remove_leaked(docs: DataFrame, leaks: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The corpus without affected documents."""
    return docs.join(leaks.select(F.col("doc_id").alias(doc_id)).distinct(), doc_id, "left_anti")


def item_report(leaks: DataFrame) -> DataFrame:
    """Documents affected per item, and the longest piece found."""
    return leaks.groupBy("item_id").agg(F.count_distinct("doc_id").alias("documents"), F.max("matched").alias("most_words"))
