"""Filling containers of fixed token capacity: bound-certified repacking.

Texts are measured in tokens of a public tokenizer, whose file is a parameter.
Documents are spread over partitions of bounded size by a hash, and each
partition is packed by best-fit decreasing.  Lower bounds from dual-feasible
functions certify what each partition needed at least.  Partitions with a gap
between their containers and the bound of all their tokens give up the
documents of their loosely filled containers; these are pooled, spread over
fewer partitions and packed again, and the new packing is kept where it needs
fewer containers.  Rounds end when a bound is met or nothing is gained.

A document longer than the capacity is the only one that is split: into full
containers and a rest, which is packed like any other document.

Defined cases: NULL, empty and blank texts have 0 tokens and no container;
repeated rows of one id are packed once per row with a copy number; a NULL id
is a document like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorewright.session import materialize

PACKED = "doc_id bigint, copy int, piece int, tokens int, part bigint, bin int, free int"


def default_tokenizer() -> str:
    """The byte-level BPE vocabulary of the public tokenizer folder."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=4)
def _encoding(path: str):  # noqa: ANN202
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Append ``tokens`` and drop the text, so that only numbers travel on."""
    path = tokenizer or default_tokenizer()

    @F.pandas_udf("int")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _encoding(path).encode_ordinary
        for s in texts:
            yield pd.Series([0 if t is None or not t.strip() else len(encode(t)) for t in s], dtype="int32")

    keep = [c for c in df.columns if c != text]
    return df.select(*[F.col(f"`{c}`") for c in keep], tokens(F.col(f"`{text}`")).alias("tokens"))


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Containers that any packing of ``sizes`` needs, by two families of dual-feasible functions.

    The first, for every threshold t up to half the capacity, counts items
    above C - t as full and drops items below t; the second rounds items to
    multiples of C / k.  A total of a dual-feasible function over C bounds the
    number of containers from below; the best is returned.
    """
    sizes = np.asarray(sizes, dtype=np.int64)
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1)
    values = np.arange(capacity + 1, dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(count * values)])  # total[i]: sum of sizes below i
    many = np.concatenate([[0], np.cumsum(count)])
    t = np.arange(0, capacity // 2 + 1)
    above = many[capacity + 1] - many[capacity - t + 1]
    middle = total[capacity - t + 1] - total[t]
    best = int(np.max(-(-(above * capacity + middle) // capacity)))
    for k in range(1, min(20, capacity)):
        scaled = (k + 1) * values
        exact = scaled % capacity == 0
        f = np.where(exact, values * k, (scaled // capacity) * capacity)  # times k, to stay in whole numbers
        best = max(best, int(-(-int((count * f).sum()) // (capacity * k))))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Container of every item, and the room left in every container.

    The containers are kept by the room they have left; a bit mask of the
    rooms that occur gives the tightest fit in constant time.
    """
    order = np.argsort(-sizes, kind="stable")
    place = np.empty(len(sizes), np.int32)
    room: list[int] = []
    having: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in order:
        s = int(sizes[i])
        fits = mask >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = having[r].pop()
            if not having[r]:
                mask &= ~(1 << r)
        else:
            b, r = len(room), capacity
            room.append(capacity)
        left = r - s
        room[b] = left
        place[i] = b
        if left:
            having[left].append(b)
            mask |= 1 << left
    return place, np.array(room, np.int32)


def _pack(items: DataFrame, capacity: int) -> DataFrame:
    """Pack each ``part`` by best-fit decreasing."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values(["tokens", "doc_id", "copy", "piece"], ascending=[False, True, True, True], kind="stable")
        place, room = best_fit_decreasing(g["tokens"].to_numpy(), capacity)
        return g.assign(bin=place, free=room[place])[["doc_id", "copy", "piece", "tokens", "part", "bin", "free"]]

    return items.select("doc_id", "copy", "piece", "tokens", "part").groupBy("part").applyInPandas(pack, PACKED)


def certify(packed: DataFrame, capacity: int) -> DataFrame:
    """``part, bins, tokens, bound, gap``: containers used against the certified bound of each partition."""

    def bound(group: pd.DataFrame) -> pd.DataFrame:
        sizes = np.repeat(group["size"].to_numpy(), group["n"].to_numpy())
        return pd.DataFrame({"part": [group["part"].iloc[0]], "bound": [lower_bound(sizes, capacity)]})

    sizes = packed.groupBy("part", F.col("tokens").alias("size")).agg(F.count("*").alias("n"))  # at most `capacity` rows a partition
    bounds = sizes.groupBy("part").applyInPandas(bound, "part bigint, bound bigint")
    used = packed.groupBy("part").agg(F.count_distinct("bin").alias("bins"), F.sum("tokens").alias("tokens"))
    return used.join(bounds, "part").withColumn("gap", F.col("bins") - F.col("bound"))


def _pieces(measured: DataFrame, doc_id: str, capacity: int) -> DataFrame:
    """Documents as items of at most the capacity; only longer ones are split."""
    t = F.col("tokens")
    m = measured.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), t).where("tokens > 0")
    copies = m.groupBy("doc_id", "tokens").agg(F.count("*").alias("n"))
    # copies of an id are numbered on from one length to the next; the window runs over lengths, not rows
    upto = F.sum("n").over(Window.partitionBy("doc_id").orderBy("tokens"))
    one = copies.withColumn("upto", upto).select("doc_id", "tokens", F.explode(F.sequence((F.col("upto") - F.col("n")).cast("int"), (F.col("upto") - 1).cast("int"))).alias("copy"))
    full = F.floor((t - 1) / capacity).cast("int")
    each = one.select("doc_id", "copy", F.posexplode(F.concat(F.array_repeat(F.lit(capacity), full), F.array((t - full * capacity).cast("int")))).alias("piece", "size"))
    return each.select("doc_id", "copy", "piece", F.col("size").alias("tokens"))


def pack(df: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, tokenizer: str | None = None, per_part: int = 20_000, rounds: int = 3, loose: float = 0.01) -> DataFrame:
    """``doc_id, copy, piece, tokens, container, free``: where every document lies.

    ``container`` is unique over the whole result; ``free`` is the room left in
    it.  A partition holds about ``per_part`` items whatever the table's size.
    """
    measured = count_tokens(df.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), text, tokenizer)
    items = materialize(_pieces(measured, doc_id, capacity), "items")
    n = items.count()
    parts = max(1, -(-n // per_part))
    key = F.xxhash64("doc_id", "copy", "piece")
    packed = materialize(_pack(items.withColumn("part", F.pmod(key, F.lit(parts)).cast("bigint")), capacity), "packed")
    offset = parts
    for r in range(rounds):
        if parts == 1 and r > 0:
            break
        # a partition is certified when it meets its own bound; what it still wastes is more than the fraction it cannot avoid
        report = certify(packed, capacity).withColumn("waste", F.col("bins") - F.col("tokens") / capacity)
        gaps = report.where((F.col("gap") > 0) | (F.col("waste") > 0.05)).select("part")
        freed = packed.where(F.col("free") > loose * capacity).join(gaps, "part", "left_semi")
        pool = materialize(freed, "pool")
        sizes = pool.agg(F.count("*").alias("n"), F.count_distinct("part", "bin").alias("bins")).first()
        if not sizes["bins"] or sizes["bins"] < 2:
            break
        parts = max(1, -(-sizes["n"] // per_part))
        spread = F.pmod(F.xxhash64("doc_id", "copy", "piece", F.lit(r)), F.lit(parts)).cast("bigint") + F.lit(offset)
        again = materialize(_pack(pool.drop("bin", "free", "part").withColumn("part", spread), capacity), "repacked")
        offset += parts
        after = again.select("part", "bin").distinct().count()
        if after >= sizes["bins"]:
            break
        kept = packed.join(pool.select("part", "bin").distinct(), ["part", "bin"], "left_anti")
        packed = materialize(kept.unionByName(again), "packed")
    container = F.concat_ws("-", F.col("part"), F.col("bin"))
    return packed.select("doc_id", "copy", "piece", "tokens", container.alias("container"), "free")


def fill_report(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: items, tokens, containers, the least that would do, and the share of unused room."""
    total = packed.agg(F.count("*").alias("items"), F.sum("tokens").alias("tokens"), F.count_distinct("container").alias("containers"))
    least = F.ceil(F.col("tokens") / capacity)
    return total.select("items", "tokens", "containers", least.alias("least_containers"), F.round(1 - F.col("tokens") / (F.col("containers") * capacity), 6).alias("unused"))
