"""Most similar vectors: multiprobe p-stable hashing with exact reranking.

Each of ``tables`` hash tables cuts ``functions`` random Gaussian projections
of the unit vector into cells of ``width``.  A vector is stored in its own
cell and looks into the ``probes`` cells that are likeliest to hold its
neighbours, in order of the estimated success of the perturbation: the sum of
squared distances to the cell walls that are crossed.  A bitmap of the cells
that hold vectors drops, before anything is shuffled, the looks into empty
ones.  The candidates of all tables are merged, weighed by a 256-bit sign
sketch that travels with the hashes, and the survivors are ranked by their
exact cosine.  The sketch lets five standard deviations pass: of the pairs
just at the floor three in ten million are lost to it, of closer ones fewer.

Size bound: the bitmap has 16 bits a cell up to ``max_bits`` (16 MB); with
more cells it drops fewer looks, the result stays the same.

On disk: vectors are kept as they came, once per class, and scaled where they
are used; looks are joined in ``LOOK_PARTS`` parts of the cells, pairs are scored
in ``SCORE_PARTS`` squared parts of the vectors, and files of one part are let go
of before the next.

Equal vectors (after scaling) form one class and are hashed once, so copies
never crowd a cell.  A crowded cell of different vectors is cut into chunks
that meet in chunk pairs; nothing is dropped.

Defined cases: vectors that are NULL, of another length, all zero, or hold
NaN, infinities or NULLs take no part; of the rows of one id the smallest
vector counts; ties in cosine go to the smaller id.  With the defaults, pairs
of cosine 0.9 are found almost always, of 0.8 mostly; recall is tested
against brute force.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorewright.session import discard, materialize, tidy


#: Bits of the sign sketch.
SKETCH = 256
MAX_BITS = 1 << 27
#: Parts of the classes, of the cells, and of each side of the scored pairs.
CLASS_PARTS, LOOK_PARTS, SCORE_PARTS = 2, 4, 3


@dataclass(frozen=True)
class Hashing:
    dimensions: int = 384
    tables: int = 10
    functions: int = 16
    width: float = 2.0
    probes: int = 20
    seed: int = 20

    def projections(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        n = self.tables * self.functions
        return (
            rng.standard_normal((self.dimensions, n)).astype(np.float32),
            rng.uniform(0, self.width, n).astype(np.float32),
            rng.standard_normal((self.dimensions, SKETCH)).astype(np.float32),
            rng.integers(1, 1 << 62, self.functions, dtype=np.int64) | 1,
        )


def perturbations(functions: int, count: int) -> list[tuple[int, ...]]:
    """The likeliest sets of ranks of cell walls to cross, best first.

    Ranks run over the 2m distances to the walls in ascending order; of wall j
    the opposite wall of the same function is 2m-1-j.  The expected squared
    distance of each rank orders the sets once for all vectors.
    """
    m = functions
    cost = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    cost += [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    sets: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(sets) < count:
        score, ranks = heapq.heappop(heap)
        if not {2 * m - 1 - r for r in ranks} & set(ranks):
            sets.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (score + cost[last + 1], (*ranks, last + 1)))
    return sets


def _slices(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Non-empty pieces of at most ``rows`` rows, so that a worker's arrays stay small whatever the batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


_HASHED = pa.schema([("id", pa.int64()), ("sketch", pa.list_(pa.int64())), ("cells", pa.list_(pa.int64()))])
_HASHED_DDL = "id bigint, sketch array<bigint>, cells array<bigint>"


def _slot(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of a cell in a bitmap whose size is a power of two."""
    x = cells.astype(np.uint64)
    with np.errstate(over="ignore"):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(33))) & np.uint64(bits - 1)


def _hash_batches(batches: Iterable[pa.RecordBatch], h: Hashing, filled: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """The home cells of every vector or, with the bitmap of filled cells, the cells of all probes that are in it."""
    planes, shift, signs, mix = h.projections()
    sets = perturbations(h.functions, h.probes) if filled is not None else [()]
    for batch in _slices(batches):
        x = _scaled(_matrix(batch.column(1)))
        bits = np.packbits(x @ signs > 0, axis=1).view(np.int64)
        scaled = (x @ planes + shift) / h.width
        cells = np.empty((len(x), h.tables, len(sets)), dtype=np.int64)
        for t in range(h.tables):
            part = scaled[:, t * h.functions : (t + 1) * h.functions]
            base = np.floor(part).astype(np.int64)
            low = part - base
            order = np.argsort(np.concatenate([low, 1 - low], axis=1), axis=1)
            with np.errstate(over="ignore"):
                home = base @ mix + np.int64(t) * np.int64(0x1E3779B97F4A7C15)
                step = np.concatenate([-mix, mix])[order]
                for p, ranks in enumerate(sets):
                    cells[:, t, p] = home + step[:, list(ranks)].sum(axis=1) if ranks else home
        flat = cells.reshape(len(x), -1)
        if filled is None:
            keep = np.ones(flat.shape, bool)
        else:
            at = _slot(flat, len(filled) * 64)
            keep = (filled[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        ends = np.concatenate([[0], np.cumsum(keep.sum(axis=1))]).astype(np.int32)
        words = np.arange(len(x) + 1, dtype=np.int32) * (SKETCH // 64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(words), pa.array(bits.reshape(-1))), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[keep]))], schema=_HASHED
        )


def _filled(stored: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of the cells in ``stored``; the words that are not zero are fetched, at most ``bits / 64``."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _slot(batch.column(0).to_numpy(), bits).astype(np.int64)
            words, which = np.unique(at >> 6, return_inverse=True)
            mask = np.zeros(len(words), np.uint64)
            np.bitwise_or.at(mask, which, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(mask.view(np.int64))], names=["word", "mask"])

    got = stored.select("cell").mapInArrow(place, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[got["word"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    return out


_UNIT = pa.schema([("key", pa.string()), ("vec", pa.list_(pa.float32())), ("unit", pa.list_(pa.float32()))])


def _scaled(x: np.ndarray) -> np.ndarray:
    """Unit vectors, rounded; not finite where a vector has none."""
    x = x.astype(np.float64)
    with np.errstate(all="ignore"):
        unit = x / np.abs(x).max(axis=1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    return np.round(unit, 7).astype(np.float32) + np.float32(0.0)


def _unit_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        x = _matrix(batch.column(1))
        unit = _scaled(x)
        keep = np.isfinite(unit).all(axis=1)
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(keep.sum() + 1, dtype=np.int32) * x.shape[1]), pa.array(v[keep].reshape(-1))) for v in (x, unit)]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), *lists], schema=_UNIT)


def _with_units(df: DataFrame, key: str, vector: str, dimensions: int) -> DataFrame:
    """``key, vec, unit``: one vector as it came, and scaled, per non-null key, of the vectors that take part."""
    v = F.col(f"`{vector}`").cast("array<float>")
    rows = df.select(F.col(f"`{key}`").cast("string").alias("key"), v.alias("v")).where("key IS NOT NULL")
    rows = rows.where(F.size("v") == dimensions)
    whole = rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    one = whole.groupBy("key").agg(F.min("v").alias("v"))
    return one.mapInArrow(_unit_batches, "key string, vec array<float>, unit array<float>")


def unit_vectors(df: DataFrame, key: str, vector: str, dimensions: int) -> DataFrame:
    """``key, unit``: one unit vector per non-null key, of the vectors that take part."""
    return _with_units(df, key, vector, dimensions).select("key", "unit")


def _exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cosine", pa.float64())])
    for batch in _slices(batches):
        x, y = _scaled(_matrix(batch.column(2))).astype(np.float64), _scaled(_matrix(batch.column(3))).astype(np.float64)
        cos = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cos)], schema=schema)


def candidate_pairs(classes: DataFrame, h: Hashing, min_cosine: float, crowd: int = 2000, z: float = 5.0, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct ``a < b`` that meet in a probed cell and pass the sketch.

    The sketch passes a pair when its estimated angle is within ``z`` standard
    deviations of ``min_cosine``'s.  Cells holding more than ``crowd`` vectors
    are cut into chunks on both sides, so a crowded cell is many tasks.
    """
    homes = materialize(classes.mapInArrow(lambda b: _hash_batches(b, h), _HASHED_DDL), "homes")
    stored = homes.select(F.col("id").alias("c"), F.col("sketch").alias("cs"), F.explode("cells").alias("cell"))
    bits = 64
    while bits < min(max_bits, 16 * h.tables * homes.count()):
        bits *= 2
    held = classes.sparkSession.sparkContext.broadcast(_filled(stored, bits))
    probed = materialize(classes.mapInArrow(lambda b: _hash_batches(b, h, held.value), _HASHED_DDL), "probed")
    held.destroy()
    looked = probed.select(F.col("id").alias("q"), F.col("sketch").alias("qs"), F.explode("cells").alias("cell"))
    parts = []
    for i in range(LOOK_PARTS):
        mine = F.pmod(F.xxhash64("cell"), F.lit(LOOK_PARTS)) == i
        parts.append(materialize(_met(stored.where(mine), looked.where(mine), min_cosine, crowd, z), "met"))
        tidy(classes.sparkSession)
    discard(homes)
    discard(probed)
    return reduce(DataFrame.unionByName, parts).distinct()


def _met(stored: DataFrame, looked: DataFrame, min_cosine: float, crowd: int, z: float) -> DataFrame:
    """``candidate_pairs`` of the given cells."""
    crowded = stored.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("cell", F.ceil(F.col("n") / crowd).cast("int").alias("chunks"))
    # every stored vector of a crowded cell lies in one chunk, every look goes to all of its chunks
    stored = stored.join(crowded, "cell", "left").withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int"), F.lit(0))).drop("chunks")
    looked = looked.join(crowded, "cell", "left").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1))).drop("chunks")
    p = float(np.arccos(min(1.0, max(-1.0, min_cosine))) / np.pi)
    most = int(np.ceil(SKETCH * (p + z * np.sqrt(p * (1 - p) / SKETCH))))
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.get("qs", i).bitwiseXOR(F.get("cs", i))) for i in range(SKETCH // 64)])
    met = looked.join(stored, ["cell", "chunk"]).where((F.col("q") != F.col("c")) & (apart <= most))
    return met.select(F.least("q", "c").alias("a"), F.greatest("q", "c").alias("b")).distinct()


def _classes(df: DataFrame, key: str, vector: str, dimensions: int) -> tuple[DataFrame, DataFrame]:
    """``key, class`` of the vectors that take part, and ``id, vec, first`` of the classes of equal ones."""
    spark = df.sparkSession
    units = _with_units(df, key, vector, dimensions)
    units = materialize(units.select("key", "vec", F.xxhash64("unit").alias("class")), "units")
    tidy(spark)
    parts = []
    for i in range(CLASS_PARTS):
        mine = units.where(F.pmod("class", F.lit(CLASS_PARTS)) == i)
        parts.append(materialize(mine.groupBy("class").agg(F.min("vec").alias("vec"), F.min("key").alias("first")).withColumnRenamed("class", "id"), "classes"))
        tidy(spark)
    members = materialize(units.select("key", "class"), "members")
    discard(units)
    return members, reduce(DataFrame.unionByName, parts)


def _ranked(units: DataFrame, classes: DataFrame, links: DataFrame, k: int) -> DataFrame:
    """``key_a, key_b, cosine, rank`` from ``links`` (``a, b, cosine``) of each class to the others near it."""
    # the k+1 smallest ids of each class are all that any member, inside or outside, can need
    members = units.select("key", "class")
    w = Window.partitionBy("class").orderBy("key")
    few = members.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k + 1).drop("place")
    links = links.unionByName(classes.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("cosine")))
    # of the classes near a class, the k+1 that begin its list hold all of its k+1 nearest keys
    ordered = Window.partitionBy("a").orderBy(F.desc("cosine"), "first")
    links = links.join(classes.select(F.col("id").alias("b"), "first"), "b").withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= k + 1).drop("place", "first")
    # keys are ranked per class, one more than k since a member is no neighbour of its own
    near = links.join(few.select(F.col("key").alias("key_b"), F.col("class").alias("b")), "b").select("a", "key_b", "cosine")
    best = near.withColumn("place", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "key_b"))).where(F.col("place") <= k + 1).drop("place")
    out = members.select(F.col("key").alias("key_a"), F.col("class").alias("a")).join(best, "a").where("key_a <> key_b")
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("key_a").orderBy(F.desc("cosine"), "key_b")))
    return ranked.where(F.col("rank") <= k).select("key_a", "key_b", "cosine", "rank")


def nearest_neighbors(df: DataFrame, key: str, vector: str, k: int = 5, min_cosine: float = 0.8, hashing: Hashing | None = None) -> DataFrame:
    """``key_a, key_b, cosine, rank``: for each key_a its k most similar keys of at least ``min_cosine``.

    Within a class of equal vectors the smallest ids come first, so even a
    class that holds a third of all rows adds k rows per member.
    """
    h = hashing or Hashing()
    units, classes = _classes(df, key, vector, h.dimensions)
    pairs = materialize(candidate_pairs(classes.select("id", "vec"), h, min_cosine), "pairs")
    part = lambda c: F.pmod(c, F.lit(SCORE_PARTS))
    parts = []
    for i, j in itertools.product(range(SCORE_PARTS), repeat=2):
        left = classes.where(part("id") == i).select(F.col("id").alias("a"), F.col("vec").alias("va"))
        right = classes.where(part("id") == j).select(F.col("id").alias("b"), F.col("vec").alias("vb"))
        both = pairs.where((part("a") == i) & (part("b") == j)).join(left, "a").join(right, "b").select("a", "b", "va", "vb")
        parts.append(materialize(both.mapInArrow(_exact, "a bigint, b bigint, cosine double").where(F.col("cosine") >= min_cosine), "close"))
        tidy(df.sparkSession)
    close = reduce(DataFrame.unionByName, parts)
    links = close.select("a", "b", "cosine").unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    return _ranked(units, classes, links, k)


def _best_batches(batches: Iterable[pa.RecordBatch], block: tuple[np.ndarray, np.ndarray], k: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cosine", pa.float64())])
    ids, y = block
    for batch in _slices(batches, 256):
        own, x = batch.column(0).to_numpy(), _scaled(_matrix(batch.column(1)))
        score = x @ y.T
        score[own[:, None] == ids[None, :]] = -2.0
        n = min(k + 1, len(ids))
        # single precision only sifts; whatever may be among the best is ranked by its exact cosine
        least = np.partition(score, len(ids) - n, axis=1)[:, len(ids) - n, None] - np.float32(1e-5)
        row, col = np.nonzero((score >= least) & (score > -1.5))
        u, v = x[row].astype(np.float64), y[col].astype(np.float64)
        cos = np.einsum("ij,ij->i", u, v) / np.sqrt(np.einsum("ij,ij->i", u, u) * np.einsum("ij,ij->i", v, v))
        order = np.lexsort((col, -cos, row))
        row, col, cos = row[order], col[order], cos[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) <= k
        yield pa.RecordBatch.from_arrays([pa.array(own[row[keep]]), pa.array(ids[col[keep]]), pa.array(cos[keep])], schema=schema)


def exact_neighbors(df: DataFrame, key: str, vector: str, k: int = 5, dimensions: int = 384, block: int = 8192) -> DataFrame:
    """``key_a, key_b, cosine, rank``: for each key_a its k most similar keys, however far.

    Hashing has nothing to hold on to where the nearest vectors are far, so
    all classes are compared, with one block of at most about ``block`` of
    them at a time on the workers.  The work grows with the square of the
    distinct vectors, memory does not grow.
    """
    spark = df.sparkSession
    units, classes = _classes(df, key, vector, dimensions)
    blocks = max(1, -(-classes.count() // block))
    links = classes.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("cosine")).limit(0)
    for i in range(blocks):
        part = classes.where(F.pmod("id", F.lit(blocks)) == i).select("id", "first", "vec").toArrow().sort_by("first").combine_chunks()
        if part.num_rows:
            held = spark.sparkContext.broadcast((part["id"].to_numpy(), _scaled(_matrix(part["vec"].combine_chunks()))))
            best = classes.select("id", "vec").mapInArrow(lambda b, held=held: _best_batches(b, held.value, k), "a bigint, b bigint, cosine double")
            links = links.unionByName(materialize(best, "best"))
            held.destroy()
    return _ranked(units, classes, links, k)
