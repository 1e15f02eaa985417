"""References to records that do not exist.

A Bloom filter over the parent keys proves most orphans without any join: a
key that is not in the filter certainly has no parent.  Only references that
pass are verified, by an exact join of their distinct (key, batch) pairs.

Rows are tested before anything is shuffled, and only orphans travel: the
distinct (key, batch) pairs of the references that pass meet the parents, the
pairs found to be orphans become a second filter, and the rows that pass
neither test never leave their task.

Size bound: a filter is sized to its keys and has as many hashes as suit its
bits per key, up to ``max_bits`` bits (16 MB) whatever the number of parents.
It is full-sized up to 11 million parents; with 100 million it still proves
about half of the orphans.  Beyond, more pairs go through the exact join; the
result stays the same.  All bits of a key lie in one word, so a test mentions
the filter once: every mention is a copy of it in the driver and in each task.

Defined cases: blank and NULL references are no references; a reference that
holds no digits stands for itself; NULL dates have month NULL; repeated rows
come out once; without parents every reference is an orphan; parents without a
readable id are skipped; an empty child table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.functions.ids import bare_id
from lorewright.session import materialize

MAX_BITS = 1 << 27


@dataclass(frozen=True)
class Bloom:
    """One row with the filter as an array of 64-bit words; its number of bits and hashes."""

    words: DataFrame
    bits: int
    hashes: int


def _two(*key: Column) -> tuple[Column, Column]:
    """Two 31-bit hashes, so that their multiples and sums never overflow."""
    return F.shiftrightunsigned(F.xxhash64(*key), 33), F.shiftrightunsigned(F.xxhash64(*key, F.lit(17)), 33)


def _place(two: tuple[Column, Column], bits: int, hashes: int) -> tuple[Column, Column]:
    """The word of a key, of ``bits / 64`` (a power of two), and its bits in that word, at most five."""
    one = F.lit(1).cast("bigint")
    mask = [F.call_function("shiftleft", one, F.shiftright(two[1], 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(hashes)]
    return two[0].bitwiseAND(F.lit(bits // 64 - 1)), reduce(Column.bitwiseOR, mask)


def bloom_filter(parents: DataFrame, two: tuple[Column, Column], max_bits: int = MAX_BITS, bits_per_key: int = 12) -> Bloom:
    """The filter of all keys, each given by its two hashes.

    The only value fetched is the approximate number of keys, to size the
    filter; the words stay in the cluster and reach the tasks as the result of
    a scalar subquery, at most ``max_bits / 64`` of them.
    """
    n = parents.agg(F.approx_count_distinct(F.xxhash64(*two))).first()[0]
    bits = 64
    while bits < min(max_bits, n * bits_per_key):
        bits *= 2
    hashes = min(5, max(1, round(0.69 * bits / max(n, 1))))
    word, mask = _place(two, bits, hashes)
    some = parents.select(word.alias("word"), mask.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    every = parents.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = some.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # written out, as every mention of a subquery is planned on its own
    one = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words"))
    return Bloom(materialize(one, "bloom"), bits, hashes)


def might_contain(bloom: Bloom, two: tuple[Column, Column]) -> Column:
    """False proves that the key was not put into the filter; evaluated in the JVM."""
    word, mask = _place(two, bloom.bits, bloom.hashes)
    return F.bitwise_not(F.get(bloom.words.scalar(), word.cast("int"))).bitwiseAND(mask) == 0


def parent_history(parents: DataFrame, deleted: DataFrame, entity: str) -> DataFrame:
    """``ref_id, first_batch, deleted_batch``: one row per parent key, deletions included."""
    there = parents.select(bare_id(F.col("id")).alias("ref_id"), F.col("batch_no").alias("first_batch"), F.lit(None).cast("int").alias("deleted_batch"))
    gone = deleted.where(F.col("entity") == entity).select(bare_id(F.col("id")).alias("ref_id"), F.lit(None).cast("int").alias("first_batch"), F.col("batch_no").alias("deleted_batch"))
    both = there.unionByName(gone).where("ref_id IS NOT NULL")
    return both.groupBy("ref_id").agg(F.min("first_batch").alias("first_batch"), F.min("deleted_batch").alias("deleted_batch"))


def _readable(c: str) -> Column:
    raw = F.trim(F.col(c))
    return F.nullif(F.coalesce(bare_id(F.col(c)), raw), F.lit(""))


def references(children: DataFrame, reference: str) -> DataFrame:
    """The rows that hold a non-blank reference: ``work_id, ref_id, upd_month, batch_no``."""
    month = F.when(F.length("updated_date") >= 7, F.substring("updated_date", 1, 7))
    rows = children.select(_readable("work_id").alias("work_id"), _readable(reference).alias("ref_id"), month.alias("upd_month"), "batch_no")
    return rows.where("ref_id IS NOT NULL")


def orphan_references(children: DataFrame, reference: str, history: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct references without a living parent at their batch, with their number of rows ``n``.

    Adds ``reason``: ``missing`` (no parent in any batch), ``late`` (a parent
    only in a later batch) or ``deleted``.  A hot key is one pair per batch in
    the verification, after map-side combination.
    """
    parents = bloom_filter(history.where("first_batch IS NOT NULL"), _two(F.col("ref_id")), max_bits)
    # tested once and written out with the answer, as each later mention would send the filter anew
    rows = materialize(references(children, reference).withColumn("_maybe", might_contain(parents, _two(F.col("ref_id")))), "references")
    gone = F.coalesce(F.col("deleted_batch") <= F.col("batch_no"), F.lit(False))
    late = F.coalesce(F.col("first_batch") > F.col("batch_no"), F.lit(False))
    why = F.when(F.col("first_batch").isNull(), "missing").when(gone, "deleted").when(late, "late")
    pairs = rows.where("_maybe").select("ref_id", "batch_no").distinct().join(history, "ref_id", "left")
    verified = materialize(pairs.select("ref_id", "batch_no", why.alias("why")).where("why IS NOT NULL"), "verified")
    pair = _two(F.col("ref_id"), F.coalesce("batch_no", F.lit(-1)))
    known = bloom_filter(verified, pair, max_bits)
    suspect = rows.where(~F.col("_maybe") | might_contain(known, pair))
    found = suspect.join(verified, ["ref_id", "batch_no"], "left").withColumn("reason", F.when(~F.col("_maybe"), "missing").otherwise(F.col("why")))
    return found.where("reason IS NOT NULL").groupBy("work_id", "ref_id", "upd_month", "batch_no", "reason").agg(F.count("*").alias("n"))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan rows, distinct missing keys and reasons per table and month."""
    by = lambda r: F.sum(F.when(F.col("reason") == r, F.col("n")).otherwise(0))
    keys = orphans.groupBy("src_table", "upd_month", "ref_id").agg(F.sum("n").alias("n"), by("missing").alias("m"), by("late").alias("l"), by("deleted").alias("d"))
    return keys.groupBy("src_table", "upd_month").agg(F.sum("n").alias("orphan_rows"), F.count("*").alias("orphan_keys"), F.sum("m").alias("missing"), F.sum("l").alias("late"), F.sum("d").alias("deleted"))
