"""Co-occurrence, neighbours, components and packing against brute force."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lorewright.llm import components, cooccurrence, neighbors, packing
from lorewright.llm.queries import LLM

# --- co-occurrence ---------------------------------------------------------------


def pairs_by_hand(rows, support, lift):
    baskets = defaultdict(set)
    for w, a in rows:
        if w is not None and a is not None:
            baskets[w].add(a)
    n = Counter(a for v in baskets.values() for a in v)
    both = Counter(p for v in baskets.values() for p in itertools.combinations(sorted(v), 2))
    return {(a, b): (c, n[a], n[b]) for (a, b), c in both.items() if c >= support and c * len(baskets) / (n[a] * n[b]) >= lift}


@pytest.mark.parametrize(("support", "lift", "block"), [(1, 0.0, 3), (2, 0.0, 4), (3, 1.5, 4), (1, 2.0, 256), (4, 0.0, 2)])
def test_cooccurrence(spark, support, lift, block):
    rng = random.Random(support * 10 + block)
    rows = [(f"w{i}", f"a{rng.randrange(25):02}") for i in range(40) for _ in range(rng.randrange(1, 6))]
    rows += [(f"big{k}", f"a{i:02}") for k in range(3) for i in range(rng.randrange(12, 22))]
    rows += [rows[0]] * 30 + [(None, "a01"), ("w1", None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "w string, a string, item string, n int")
    got = {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b) for r in cooccurrence.cooccurrence(df, "w", "a", support, lift, block).collect()}
    assert got == pairs_by_hand(rows, support, lift)


def test_long_lists_of_large_baskets_are_cut(spark, monkeypatch):
    monkeypatch.setattr(cooccurrence, "LONGEST", 3)
    rng = random.Random(9)
    rows = [(f"big{k}", f"a{i:02}") for k in range(14) for i in range(20) if i < 2 or rng.random() < 0.4] + [(f"w{i}", f"a{rng.randrange(20):02}") for i in range(60) for _ in range(3)]
    df = spark.createDataFrame(rows, "w string, a string")
    got = {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b) for r in cooccurrence.cooccurrence(df, "w", "a", 2, 0.0, 4).collect()}
    assert got == pairs_by_hand(rows, 2, 0.0)


def test_cooccurrence_of_nothing(spark):
    df = spark.createDataFrame([], "w string, a string")
    assert cooccurrence.cooccurrence(df, "w", "a").count() == 0
    one = spark.createDataFrame([("w", "a"), ("w", "a")], "w string, a string")
    assert cooccurrence.cooccurrence(one, "w", "a").count() == 0


def test_pairs_that_met_once(spark, sf):
    """Every pair comes out of p3_pairs, with the numbers of its SQL."""
    duckdb = pytest.importorskip("duckdb")
    from tools_oracle import compare, connect

    assert duckdb
    con = connect(sf)
    assert compare(spark, con, "p3_pairs", sf).startswith("ok")
    ids = "SELECT regexp_extract(work_id, '([0-9]+)\\s*$', 1) AS w, regexp_extract(author_id, '([0-9]+)\\s*$', 1) AS a FROM works_authorships"
    want = con.execute(f"WITH d AS (SELECT DISTINCT * FROM ({ids}) WHERE w <> '' AND a <> '') SELECT count(*) FROM (SELECT DISTINCT x.a, y.a FROM d x JOIN d y ON x.w = y.w AND x.a < y.a)").fetchone()[0]
    assert con.execute(f"SELECT count(*) FROM ({LLM.sql['p3_pairs']})").fetchone()[0] == want


# --- neighbours --------------------------------------------------------------------


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 384))
    near = np.repeat(base[:100], 3, axis=0)
    near = near + rng.standard_normal(near.shape) * rng.uniform(0.1, 0.6, (len(near), 1))
    v = np.concatenate([base, near]) * rng.uniform(0.3, 9, (600, 1))
    rows = [(f"{i:04}", [float(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame([(*r, "x") for r in rows + rows[:5]], "w string, vec array<float>, key string")
    got = {(r.key_a, r.key_b) for r in neighbors.nearest_neighbors(df, "w", "vec", 5, 0.8).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -1)
    want = {(f"{i:04}", f"{j:04}") for i in range(600) for j in np.argsort(-s[i])[:5] if s[i, j] >= 0.8}
    assert len(want) > 300 and len(want & got) / len(want) >= 0.9
    assert all(s[int(a), int(b)] >= 0.8 - 1e-5 for a, b in got)


@pytest.mark.parametrize("block", [90, 8192])
def test_neighbors_however_far(spark, sf, block):
    """All k true neighbours of every vector, most of them far below 0.8."""
    from pyspark.sql import functions as F

    from lorewright.functions.ids import bare_id

    v = spark.read.parquet(f"{sf}/works_vector.parquet").select(bare_id(F.col("work_id")).alias("w"), "vec")
    units = sorted((r.key, r.unit) for r in neighbors.unit_vectors(v, "w", "vec", 384).collect())
    keys, u = [k for k, _ in units], np.array([x for _, x in units], dtype=np.float64)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    fifth = {k: np.sort(x)[-5] for k, x in zip(keys, s)}
    at = {k: i for i, k in enumerate(keys)}
    got = neighbors.exact_neighbors(v, "w", "vec", 5, block=block).collect() if block < 8192 else LLM.queries["p5_neighbors"](spark, sf).collect()
    assert len(keys) > 30 and Counter(r.key_a for r in got) == {k: 5 for k in keys}
    assert all(r.key_a != r.key_b and s[at[r.key_a], at[r.key_b]] >= fifth[r.key_a] - 1e-6 for r in got)
    assert sum(r.cosine < 0.8 for r in got) > len(got) / 2


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [1.0] * 4
    rows = [("a", good), ("b", [2.0] * 4), ("c", None), ("d", []), ("e", [1.0] * 3), ("f", [0.0] * 4), ("g", [1.0, nan, 1.0, 1.0]), ("h", [inf, 1.0, 1.0, 1.0]), ("i", [None, 1.0, 1.0, 1.0]), (None, good)]
    df = spark.createDataFrame(rows, "w string, vec array<float>")
    h = neighbors.Hashing(dimensions=4, tables=2, functions=4)
    got = [(r.key_a, r.key_b, round(r.cosine, 6), r["rank"]) for r in neighbors.nearest_neighbors(df, "w", "vec", 5, 0.8, h).orderBy("key_a").collect()]
    assert got == [("a", "b", 1.0, 1), ("b", "a", 1.0, 1)]
    assert neighbors.nearest_neighbors(df.limit(0), "w", "vec", 5, 0.8, h).count() == 0


def test_copies_go_to_the_smallest_ids(spark):
    rows = [(f"{i:03}", [1.0, 2.0, 3.0, 4.0]) for i in range(200)] + [("zz", [1.0, 2.0, 3.0, 4.1])]
    df = spark.createDataFrame(rows, "w string, vec array<float>")
    h = neighbors.Hashing(dimensions=4, tables=4, functions=2)
    got = defaultdict(list)
    for r in neighbors.nearest_neighbors(df, "w", "vec", 3, 0.8, h).collect():
        got[r.key_a].append(r.key_b)
    assert sorted(got["100"]) == sorted(got["zz"]) == ["000", "001", "002"] and sorted(got["000"]) == ["001", "002", "003"]
    assert all(len(v) == 3 for v in got.values()) and len(got) == 201


def test_crowded_cells_lose_nothing(spark):
    rng = np.random.default_rng(2)
    v = np.ones((60, 4)) + rng.standard_normal((60, 4)) * 0.01
    df = neighbors.unit_vectors(spark.createDataFrame([(str(i), [float(x) for x in r]) for i, r in enumerate(v)], "w string, vec array<float>"), "w", "vec", 4)
    classes = df.selectExpr("cast(key as bigint) as id", "unit")
    h = neighbors.Hashing(dimensions=4, tables=2, functions=2, width=4.0, probes=2)
    pairs = [{(r.a, r.b) for r in neighbors.candidate_pairs(classes, h, 0.8, crowd).collect()} for crowd in (7, 1000)]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 1000


def test_scratch_files_of_neighbors_stay_small(spark, tmp_path):
    """What is left in the shared folder is about one copy of the vectors, not every step's."""
    from lorewright.session import shared_dir

    size = lambda p: sum(f.stat().st_size for f in p.rglob("*.parquet"))
    rng = np.random.default_rng(7)
    v = np.round(rng.standard_normal((3000, 384)) * 0.05, 3)
    spark.createDataFrame([(str(i), [float(x) for x in r]) for i, r in enumerate(v)], "w string, vec array<float>").write.option("compression", "zstd").parquet(str(tmp_path / "v"))
    scratch = Path(shared_dir(spark).removeprefix("file:"))
    before = size(scratch)
    neighbors.nearest_neighbors(spark.read.parquet(str(tmp_path / "v")), "w", "vec", 5, 0.8)
    assert size(scratch) - before < 1.5 * size(tmp_path / "v")


def test_perturbations_are_valid_and_ordered():
    sets = neighbors.perturbations(4, 30)
    assert sets[0] == () and sets[1] == (0,) and len(set(sets)) == len(sets) == 30
    assert all(not {7 - r for r in s} & set(s) for s in sets)


# --- components ----------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    rng = random.Random(seed)
    n = [20, 60, 200, 40][seed]
    edges = [(f"{rng.randrange(n):03}", f"{rng.randrange(n):03}") for _ in range(int(n * 0.7))]
    if seed == 3:
        edges = [(f"{i:03}", f"{i + 1:03}") for i in range(40)]  # a path
    parent: dict[str, str] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in list(parent)}
    df = spark.createDataFrame(edges + [(None, "1"), ("2", "2x2"[:1])], "a string, b string")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == want


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


# --- packing --------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=40))
def test_best_fit_and_bound(sizes):
    s = np.array(sizes, np.int64)
    place, room = packing.best_fit_decreasing(s, 30)
    load = Counter()
    for b, x in zip(place.tolist(), sizes):
        load[b] += x
    assert all(30 - load[b] == room[b] >= 0 for b in range(len(room)))
    assert -(-sum(sizes) // 30) <= packing.lower_bound(s, 30) <= len(room)


def test_bound_beats_the_volume():
    assert packing.lower_bound(np.array([16] * 10), 30) == 10  # no two fit together
    assert packing.lower_bound(np.array([], np.int64), 30) == 0
    assert packing.lower_bound(np.array([11] * 9), 30) == 5  # two each: the volume alone says 4


def test_pack(spark):
    rng = random.Random(4)
    texts = [(i, " ".join("word" for _ in range(rng.choice([3, 10, 40, 90, 250])))) for i in range(400)] + [(1000, None), (1001, ""), (1002, "  "), (5, "again"), (5, "again")]
    df = spark.createDataFrame([(*t, "x") for t in texts], "doc_id bigint, text string, tokens string")
    packed = packing.pack(df, capacity=100, per_part=60)
    rows = packed.collect()
    load, free = Counter(), {}
    for r in rows:
        load[r.container] += r.tokens
        free[r.container] = r.free
    assert all(load[c] + free[c] == 100 for c in load)
    measured = {(r.doc_id, r.tokens) for r in packing.count_tokens(df.select("doc_id", "text")).collect() if r.tokens}
    by_doc = Counter()
    for r in rows:
        by_doc[(r.doc_id, r.copy)] += r.tokens
    whole = Counter(by_doc.values())
    assert sum(whole.values()) == 402 and {r[0] for r in measured} == {r.doc_id for r in rows}
    pieces = Counter((r.doc_id, r.copy) for r in rows)
    assert all(n == 1 or by_doc[k] > 100 for k, n in pieces.items())
    f = packing.fill_report(packed, 100).first()
    assert f.containers <= f.least_containers * 1.05 + 1
    assert packing.pack(df.limit(0), capacity=100).count() == 0
    assert packing.certify(packing._pack(packed.selectExpr("doc_id", "copy", "piece", "tokens", "0L as part"), 100), 100).first().gap >= 0
