"""Nested records, orphan references and heavy keys: defined cases and brute force."""

from __future__ import annotations

import json
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lorewright.operators import merkle, orphans, skew

# --- nested records -------------------------------------------------------------


def store(spark, *lines):
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(lines)], "raw_id bigint, raw_json string, node string")
    return merkle.build_store(df, "raw_id", "raw_json")


def test_equal_subtrees_are_stored_once(spark):
    author = {"id": "A1", "orcid": None}
    a = {"id": "W1", "authorships": [{"author": author}, {"author": {"id": "A1"}}]}
    b = {"authorships": [{"author": {"id": "A1"}}], "id": "W2", "x": {"y": [1, 2, {"z": 3}]}}
    s = store(spark, json.dumps(a), json.dumps(b), json.dumps(a, indent=1), json.dumps({**a, "extra": None}))
    roots = {r.record: r.root for r in s.records.collect()}
    assert roots[0] == roots[2] == roots[3] != roots[1]
    assert s.objects.where(F.get_json_object("payload", "$.id") == "A1").count() == 1
    places = sorted((r.field, r.ordinal) for r in s.bridges.where(F.col("parent") == roots[0]).collect())
    assert places == [("authorships", 0), ("authorships", 1)]
    values = [(r.ordinal, r.value, r.type, r.child is None) for r in s.bridges.where("field = 'y'").orderBy("ordinal").collect()]
    assert values == [(0, "1", "number", True), (1, "2", "number", True), (2, None, "object", False)]


APART = [
    ({"r": ["W11", "W12"]}, {"r": ["W11\x1er\x1f1\x1f\x1fW12"]}), ({"r": [1]}, {"r": ["1"]}), ({"r": [True]}, {"r": ["true"]}), ({"r": []}, {}), ({"r": [1, None]}, {"r": [1]}),
    ({"r": [None, 1]}, {"r": [1]}), ({"r": {"a": 1}}, {"r": [{"a": 1}]}), ({"r": [[1, 2]]}, {"r": [[1], [2]]}), ({"r": [[]]}, {"r": []}), ({"a": 1, "b": [2]}, {"a": 1, "b": [2, 2]}),
    ({"r": "[1]"}, {"r": [1]}), ({"a": {"b": 1}, "c": {"d": 2}}, {"a": {"d": 2}, "c": {"b": 1}}), ({"r": 1}, {"r": 1.0}), ({"r": "x"}, {"r": ["x"]}),
]


def test_different_objects_have_different_identities(spark):
    s = store(spark, *[json.dumps(x) for pair in APART for x in pair])
    roots = {r.record: r.root for r in s.records.collect()}
    assert all(roots[2 * i] != roots[2 * i + 1] for i in range(len(APART)))


def test_separators_in_values_lose_no_reference(spark):
    lines = [json.dumps({"id": "W1", "referenced_works": x}) for x in (["W11", "W12"], ["W11\x1ereferenced_works\x1f1\x1f\x1fW12"])]
    got = {(r.record, r.item_pos, r.referenced_work_id) for r in merkle.flat_works(store(spark, *lines))["works_referenced_works"].collect()}
    assert got == {(0, 0, "11"), (0, 1, "12"), (1, 0, "12")}


def test_objects_in_arrays_of_arrays_are_stored(spark):
    s = store(spark, json.dumps({"id": "W1", "x": [[{"id": "A1"}, 3], {"id": "A1"}]}))
    assert s.nodes.where("kind = 'object' AND id = 'A1'").count() == 1
    array = s.bridges.where("field = 'x' AND type = 'array'").first().child
    assert sorted((r.ordinal, r.type) for r in s.bridges.where(F.col("parent") == array).collect()) == [(0, "object"), (1, "number")]


def rebuild(nodes, node):
    """The value a stored node stands for."""
    n = nodes[node]
    out = json.loads(n.payload)
    arrays = {f: [None] * k for f, k in json.loads(n.arrays).items()}
    for c in n.children:
        v = rebuild(nodes, c.child) if c.child else c.value if c.type == "string" else json.loads(c.value)
        if c.listed:
            arrays[c.field][c.ordinal] = v
        else:
            out[c.field] = v
    return arrays[""] if n.kind == "array" else {**out, **arrays}


def test_round_trip_of_every_record(spark, sf):
    """Every complete record of the test table comes back from the store, null fields apart."""

    def plain(v):
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items() if x is not None}
        return [plain(x) for x in v] if isinstance(v, list) else v

    raw = spark.read.parquet(f"{sf}/works_raw.parquet")
    s = merkle.build_store(raw, "raw_id", "raw_json")
    nodes, texts = {r.node: r for r in s.nodes.collect()}, {r.raw_id: r.raw_json for r in raw.collect()}
    whole = [r for r in s.records.collect() if r.root]
    assert len(whole) > 10 and all(rebuild(nodes, r.root) == plain(json.loads(texts[r.record])) for r in whole)


def test_object_counts_against_brute_force(spark, sf):
    from lorewright.plans.core_queries import CORE

    uses = defaultdict(Counter)

    def canonical(v):
        if isinstance(v, dict):
            return {k: canonical(x) for k, x in sorted(v.items()) if x is not None}
        return [canonical(x) for x in v] if isinstance(v, list) else v

    def visit(v, field):
        if isinstance(v, list):
            for x in v:
                visit(x, field)
        elif isinstance(v, dict):
            if field:
                uses[field][json.dumps(canonical(v))] += 1
            for k, x in v.items():
                if k != "abstract_inverted_index":
                    visit(x, k)

    for r in spark.read.parquet(f"{sf}/works_raw.parquet").collect():
        try:
            v = json.loads(r.raw_json)
        except (TypeError, ValueError):
            continue
        if isinstance(v, dict):
            visit(v, "")
    got = {r.field: (r.occurrences, r.objects) for r in CORE.queries["p1_object_counts"](spark, sf).collect()}
    assert len(got) > 3 and got == {f: (sum(c.values()), len(c)) for f, c in uses.items()}


@pytest.mark.parametrize("line", [None, "", "  ", "null", "[]", "[{}]", '"x"', "{", '{"id": "W1"', '{"id": "W1"} x', '{"id": NaN}', "{'id': 1}"])
def test_broken_lines_have_no_root(spark, line):
    assert [r.root for r in store(spark, line).records.collect()] == [None]


def test_flat_tables(spark):
    w = {
        "id": " https://k/W1 ",
        "authorships": [
            None, {"author": None}, {"author": {"id": " "}},
            {"author_position": "first", "author": {"id": "https://k/A5"}, "institutions": [{"id": ""}, {"id": "I7"}, None, {"id": "I8"}]},
            {"author": {"id": "A6"}, "institutions": []},
        ],
        "topics": {"id": "T3"}, "referenced_works": [None, "", "W9", "W9"], "surrogate": "\ud800",
    }
    bare = {"id": "W2", "authorships": {"author": {"id": "A1"}, "institutions": {"id": "I1"}}, "topics": None, "referenced_works": []}
    t = merkle.flat_works(store(spark, json.dumps(w), json.dumps(bare), json.dumps({"id": ""}), json.dumps({"x": 1})))
    got = {k: sorted((r.record, r.item_pos) for r in v.collect()) for k, v in t.items()}
    assert got["works"] == [(0, 0), (1, 0)]
    ships = sorted((r.record, r.item_pos, r.work_id, r.author_id, r.institution_id or "") for r in t["works_authorships"].collect())
    assert ships == [(0, 3, "1", "5", "7"), (0, 3, "1", "5", "8"), (0, 4, "1", "6", ""), (1, 0, "2", "1", "1")]
    assert got["works_topics"] == [(0, 0)] and got["works_referenced_works"] == [(0, 2), (0, 3)]


def test_uses_at_every_depth(spark, tmp_path):
    """An author below two authorships of one record and one of another counts three times."""
    from lorewright.plans.core_queries import CORE

    a = {"author": {"id": "A1", "last": {"id": "I1"}}}
    lines = [json.dumps({"id": "W1", "authorships": [{**a, "n": 1}, {**a, "n": 2}]}), json.dumps({"id": "W2", "authorships": [{**a, "n": 1}], "last": {"id": "I1"}}), "{"]
    spark.createDataFrame(list(enumerate(lines)), "raw_id bigint, raw_json string").write.parquet(f"{tmp_path}/works_raw.parquet")
    got = {r.field: (r.occurrences, r.objects) for r in CORE.queries["p1_object_counts"](spark, str(tmp_path)).collect()}
    assert got == {"authorships": (3, 2), "author": (3, 1), "last": (4, 1)}


def test_long_text_and_empty_table(spark):
    long = json.dumps({"id": "W1", "title": "x" * 3_000_000})
    t = merkle.flat_works(store(spark, long))
    assert len(t["works"].first().title) == 3_000_000
    empty = spark.createDataFrame([], "raw_id bigint, raw_json string")
    assert all(v.count() == 0 for v in merkle.flat_works(merkle.build_store(empty, "raw_id", "raw_json")).values())


@pytest.mark.parametrize("levels", [600, 1200, 5000])
def test_depth_loses_no_row(spark, levels):
    deep = '{"a":' * levels + '[[{"id": "A1"}]]' + "}" * levels
    line = '{"id": "W1", "referenced_works": ["W2", null, "W3"], "x": ' + deep + "}"
    s = store(spark, line, line.replace("W3", "W4"), "[" * levels + "]" * levels, line[:-1])
    assert [r.problem for r in s.records.orderBy("record").collect()] == [None, None, "no object", "broken"]
    got = {(r.record, r.item_pos, r.referenced_work_id) for r in merkle.flat_works(s)["works_referenced_works"].collect()}
    assert got == {(0, 0, "2"), (0, 2, "3"), (1, 0, "2"), (1, 2, "4")}
    assert s.nodes.count() == levels + 4  # two roots; the levels, the outer and inner array and the object are shared
    assert merkle.object_uses(spark.createDataFrame([(line,)], "t string"), "t").agg(F.sum("n")).first()[0] == levels + 1


@pytest.mark.parametrize("text", ['{"a": [1, -2.5e3, true, null, "x\\u00e9", {}, [], {"b": {}}]}', "[]", '"x"', " { } ", "[1,]", '{"a" 1}', '{"a": 1,}', "[1 2]", "{]", "", "nul", '{"a": 01}', "[1] x", '"'])
def test_deep_parser_reads_like_the_plain_one(text):
    try:
        want = json.loads(text)
    except ValueError:
        with pytest.raises((ValueError, IndexError)):
            merkle._parse_deep(text)
    else:
        assert merkle._parse_deep(text) == want


# --- orphan references ------------------------------------------------------------

CHILD = "work_id string, ref string, updated_date string, batch_no int, ref_id string"


def found(spark, children, parents, deleted, bits=1 << 12):
    c = spark.createDataFrame([(*x, "clash") for x in children], CHILD)
    p = spark.createDataFrame(parents, "id string, batch_no int")
    d = spark.createDataFrame(deleted, "entity string, id string, batch_no int")
    rows = orphans.orphan_references(c, "ref", orphans.parent_history(p, d, "works"), bits)
    return sorted((r.work_id, r.ref_id, r.upd_month, r.reason, r.n) for r in rows.collect())


def test_orphan_reasons(spark):
    children = [
        ("W1", "W5", "2024-01-02", 0), ("W1", "5", "2024-01-03", 0), ("1", "6", "2024-01-02", 0), ("1", "7", None, 1),
        ("1", " ", "2024-01-02", 0), ("1", None, "2024-01-02", 0), ("2", "8", "2024-01-02", 0), ("2", "8", "2024-01-02", 2), ("2", "odd", "2024-01-02", 2),
    ]
    parents = [("https://k/W6", 0), ("6", 3), ("7", 2), ("8", 0), (None, 0), ("", 0)]
    deleted = [("works", "8", 2), ("authors", "6", 0)]
    assert found(spark, children, parents, deleted) == [
        ("1", "5", "2024-01", "missing", 2), ("1", "7", None, "late", 1), ("2", "8", "2024-01", "deleted", 1), ("2", "odd", "2024-01", "missing", 1),
    ]


def test_orphans_of_empty_tables(spark):
    assert found(spark, [], [("1", 0)], []) == []
    assert found(spark, [("1", "2", "2024-01-01", 0)], [], []) == [("1", "2", "2024-01", "missing", 1)]


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_orphans_against_brute_force(spark, bits):
    """A filter that is far too small only sends more pairs to the join."""
    rng = random.Random(3)
    parents = [(str(rng.randrange(400)), rng.randrange(4)) for _ in range(300)]
    deleted = [("works", str(rng.randrange(400)), rng.randrange(4)) for _ in range(40)]
    children = [(str(i % 50), str(rng.randrange(600)) if i % 3 else "7", "2024-02-01", rng.randrange(4)) for i in range(900)]
    first, gone = {}, {}
    for i, b in parents:
        first[i] = min(b, first.get(i, 9))
    for _, i, b in deleted:
        gone[i] = min(b, gone.get(i, 9))
    want = Counter((w, r) for w, r, _, b in children if r not in first or first[r] > b or gone.get(r, 9) <= b)
    got = Counter()
    for w, r, _, _, n in found(spark, children, parents, deleted, bits):
        got[(w, r)] += n
    assert got == want


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    for most, wrong in ((orphans.MAX_BITS, 100), (1 << 13, 6500)):  # 12 bits a key or more, then fewer than 2
        bloom = orphans.bloom_filter(keys, orphans._two(F.col("k")), max_bits=most)
        inside = keys.select(orphans.might_contain(bloom, orphans._two(F.col("k"))).alias("m"))
        outside = spark.range(10_000, 20_000).select(orphans.might_contain(bloom, orphans._two(F.col("id").cast("string"))).alias("m"))
        assert bloom.bits <= most and inside.where("NOT m").count() == 0 and outside.where("m").count() < wrong


def test_bloom_filter_is_mentioned_once(spark):
    """Each mention is a copy of up to 16 MB in the driver; 24 of them did not fit."""
    mentions = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("scalar-subquery")
    keys = spark.range(50).select(F.col("id").cast("string").alias("k"))
    bloom = orphans.bloom_filter(keys, orphans._two(F.col("k")))
    assert mentions(keys.where(orphans.might_contain(bloom, orphans._two(F.col("k"))))) == 1
    c = spark.createDataFrame([("1", "5", "2024-01-02", 0, "clash"), ("1", "7", None, 1, "clash")], CHILD)
    p = spark.createDataFrame([("7", 0)], "id string, batch_no int")
    d = spark.createDataFrame([("works", "7", 1)], "entity string, id string, batch_no int")
    assert mentions(orphans.orphan_references(c, "ref", orphans.parent_history(p, d, "works"))) == 1


# --- heavy keys ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else str(rng.randrange(40)), rng.randrange(-50, 200) ** 3 if i % 11 else None) for i in range(6000)]
    rows += [(None, 1)] * 100 + [("one", 4)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "k string, v bigint, key string")


def test_key_statistics(skewed):
    rows, df = skewed
    values = defaultdict(list)
    for k, v in rows:
        values[k].append(v)
    got = {r.key: r for r in skew.key_statistics(skew.value_frequencies(df, "k", "v")).collect()}
    assert set(got) == set(values)
    for k, vs in values.items():
        c = Counter(v for v in vs if v is not None)
        mode = min(c, key=lambda x: (-c[x], x)) if c else None
        assert (got[k]["rows"], got[k].distinct_values, got[k].mode, got[k].mode_rows) == (len(vs), len(c), mode, c[mode] if c else 0)


def test_heavy_keys(skewed, spark):
    rows, df = skewed
    n = Counter(k for k, _ in rows)
    want = {k: c for k, c in n.items() if k is not None and c >= 0.01 * len(rows)}
    assert {r.key: r["rows"] for r in skew.heavy_keys(skew.value_frequencies(df, "k", "v"), 0.01).collect()} == want
    empty = skew.value_frequencies(df.limit(0), "k", "v")
    assert skew.heavy_keys(empty).count() == 0 and skew.key_statistics(empty).count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 256])
def test_percentiles(skewed, ranges):
    rows, df = skewed
    values = defaultdict(list)
    for k, v in rows:
        if v is not None and k is not None:
            values[k].append(v)
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.key, r.probability): r.value for r in skew.weighted_percentiles(skew.value_frequencies(df, "k", "v"), ps, ranges).where("key IS NOT NULL").collect()}
    for k, vs in values.items():
        vs.sort()
        for p in ps:
            at = max(1, -(-round(p * len(vs), 9) // 1))
            assert got[(k, p)] == vs[int(at) - 1], (k, p)


def test_chunked_lists(skewed):
    rows, df = skewed
    want = Counter(rows)
    got: Counter = Counter()
    longest = 0
    for r in skew.chunked_lists(skew.value_frequencies(df, "k", "v"), 50).collect():
        longest = max(longest, len(r["values"]))
        for v, n in zip(r["values"], r.weights):
            got[(r.key, v)] += n
    assert got == want and longest < 120


def test_lists_of_every_heavy_table(spark, sf):
    """The lists of each table hold all of its rows."""
    from lorewright.plans.core_queries import CORE, HEAVY

    rows = CORE.queries["p6_lists"](spark, sf).select("src_table", F.explode("weights").alias("n")).groupBy("src_table").agg(F.sum("n").alias("n"))
    assert {r.src_table: r.n for r in rows.collect()} == {n: spark.read.parquet(f"{sf}/{n}.parquet").count() for n, _, _ in HEAVY}
