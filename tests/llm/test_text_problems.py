"""Names, titles, increments, leakage and truncation."""

from __future__ import annotations

import os
import random

import pytest

from lorewright.llm import incremental, leakage, names, titles, truncation
from lorewright.llm.hot import split_join

# --- names -----------------------------------------------------------------------

SAME = [
    ("Jake Frosokrner", "Jacob Frosokriner"), ("J. P. Corvítzaberg", "Jonathan P. Corvitzaberg"), ("Ulböppawell EP", "Eugenia Philippa Ulböppawell"),
    ("Elkirosvich, Susanna", "Susanna Gabriel Elkirosvich"), ("WREST Survey Team", "Wendambre Radial Electrodes Survey Team"), ("Peggy  Zubka", "MARGARET ZUBKA"),
    ("The Plesebbo Consortium on Fluvial Films", "Plesebbo Fluvial Films Consortium"), ("PFFC", "Plesebbo Fluvial Films Consortium"),
    ("ROSKOTEL COMPOSITE LOOMS SURVEY TEAM (RCLST)", "Roskotel Composite Looms Survey Team"), ("ZARERGOVÍCH Eugenia", "Eugeina Zarergovtch"),
    ("Y. Kestupemer", "Kestuperner, Yolanda"), ("david g. tamenz0vich", "David G. Tamenzovich"), ("Dr. Esther J. Zarutimski", "Esther Zarutimski"),
    ("Fred Zubokrira", "Alfred Zubokrira"), ("Thea Zubokrira", "Theodora Zubokrira"), ("T. Zubokrira", "Thea Zubokrira"), ("Sigrid Breombaka", "Sigord Breombaka"),
    ("Anna Vikunsimann-Urbingueau", "Anna Vikunsimann"), ("Simon Fr0sicho1is", "Simon Frosicholis"),
]
OTHER = [
    ("Frances Breethölberg", "William Breethölberg"), ("Anna B. Zubokrira", "Anna C. Zubokrira"), ("J. Smithwell", "Robert Smithwell"),
    ("Matthew Gundadonski", "Matthew Jundimonski"), ("Plesebbo Fluvial Films Consortium", "Plesebbo Boreal Films Consortium"), ("Zubokrira", "Anna Zubokrira"),
]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same_names(a, b):
    assert names.same_name(names.parse_name(a), names.parse_name(b)) and names.same_name(names.parse_name(b), names.parse_name(a))


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_other_names(a, b):
    assert not names.same_name(names.parse_name(a), names.parse_name(b))


def test_common_given_names_are_no_slips_of_each_other(spark):
    a, b = names.parse_name("Robert Zubokrira"), names.parse_name("Rupert Zubokrira")
    assert names.same_name(a, b) and not names.same_name(a, b, frozenset({"robert", "rupert"}))
    assert names.same_name(a, names.parse_name("Bob Zubokrira"), frozenset({"robert", "bob"}))
    rows = [(f"p|{g}|x",) for g in ["robert"] * 6 + ["rupert"] * 5 + ["rare", "r"]] + [("g|robert|x",)] * 9
    assert names.established_names(spark.createDataFrame(rows, "name string")) == {"robert", "rupert"}
    assert names.established_names(spark.createDataFrame([], "name string")) == frozenset()


def test_alternative_lists():
    p = names.parse_alternatives
    assert p('["A, B", "C"]') == ["A, B", "C"] and p("['A. B', \"C D\"]") == ["A. B", "C D"] and p("Chel, Anna") == ["Chel, Anna"]
    assert p("A. P. Zub, Alicia P. Zub") == ["A. P. Zub", "Alicia P. Zub"] and p("a; b") == ["a", "b"] and p(None) == p(" ") == p("[]") == []


def test_abbreviations_are_no_names_of_their_own():
    assert len(names.names_of(["Philippa Eskumarson"], ['["P. Eskumarson"]'])) == 1
    assert len(names.names_of(["Janina Chelevanwell"], ["Janina Fjorubinski"])) == 2
    assert names.names_of([None, "", "?!"], [None]) == []


def authors(spark, rows):
    return spark.createDataFrame([(*r, "x", 0, "2023-01-01") for r in rows], "id string, display_name string, display_name_alternatives string, last_known_institution string, orcid string, name string, batch_no int, updated_date string")


def test_author_pairs(spark):
    o = "https://orcid.example/9990-9000-0005-9960"
    rows = [
        ("A1", "Janina Chelevanwell", "['Janina Fjorubinski']", "I7", None), ("A2", "J. Fjorubinski", None, "7", ""), ("3", "Janina Chelevanwel", "", " 7", None),
        ("4", "Janina Chelevanwell", None, "8", None), ("5", "Janina Chelevanwell", None, None, None), ("6", "Robert Chelevanwell", None, "7", None),
        ("7", "Oscar Plesingura", None, None, o), ("8", "Plesingura O", None, "9", "9990900000059960"), ("9", None, None, "7", None), ("10", " ", "", "7", None),
        (None, "Janina Chelevanwell", None, "7", None), ("A1", "Janina Chelevanwell", "['Janina Fjorubinski']", "I7", None), ("11", "?", "?", "7", o),
    ]
    got = {tuple(r) for r in names.cluster_pairs(names.author_clusters(authors(spark, rows))).collect()}
    assert got == {("1", "2"), ("1", "3"), ("2", "3"), ("7", "8")}
    assert names.author_clusters(authors(spark, rows[:1])).count() == 0
    assert names.author_clusters(authors(spark, []).limit(0)).count() == 0


def test_a_crowd_of_equal_names_is_a_star(spark):
    rows = [(str(i), "Oscar Plesingura", None, "7", None) for i in range(100, 160)] + [("200", "Oscar Plesingurra", None, "7", None)]
    df = authors(spark, rows)
    assert names.author_links(df).count() == 60 and names.author_clusters(df).select("cluster").distinct().count() == 1


@pytest.mark.parametrize("query", ["p7_found", "p7_clusters"])
def test_authors_never_reach_the_driver_as_a_broadcast(spark, sf, query):
    """The size of a Parquet file says little about its rows; by it the driver was sent tables that grow with the data."""
    from lorewright.llm.queries import LLM

    done = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = {x.executionId() for x in list_of(done.executionsList())}
    rows = LLM.queries[query](spark, sf).collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    plans = [x.physicalPlanDescription() for x in list_of(done.executionsList()) if x.executionId() not in before]
    assert rows and len(plans) > 10 and not any("Broadcast" in p for p in plans)


def list_of(seq):
    return [seq.apply(i) for i in range(seq.size())]


@pytest.mark.parametrize("size", [3, 24, 2000, 10_000])
@pytest.mark.parametrize("shape", ["chain", "star"])
def test_groups_of_every_size_hold_together(spark, size, shape):
    edges = [(f"{i:05}", f"{i + 1:05}") if shape == "chain" else ("00000", f"{i + 1:05}") for i in range(size - 1)] + [("x1", "x2")]
    got = names.clusters_of(spark.createDataFrame(edges, "a string, b string"))
    assert {(r.cluster, r["count"]) for r in got.groupBy("cluster").count().collect()} == {("00000", size), ("x1", 2)}


@pytest.mark.parametrize("crowd", [3, 10_000])
def test_crowded_keys_join_in_chunks(spark, crowd):
    left = spark.createDataFrame([("hot", f"l{i}") for i in range(40)] + [("cold", "l"), ("alone", "l")], "k string, x string")
    right = spark.createDataFrame([("hot", f"r{i}") for i in range(25)] + [("cold", "r"), ("other", "r")], "k string, y string")
    got = sorted(tuple(r) for r in split_join(left, right, ["k"], "x", "y", crowd).select("k", "x", "y").collect())
    assert got == sorted([("hot", f"l{i}", f"r{j}") for i in range(40) for j in range(25)] + [("cold", "l", "r")])
    assert split_join(left.limit(0), right, ["k"], "x", "y", crowd).count() == 0


# --- titles and increments ---------------------------------------------------------


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Holistic grains &amp; <i>foo</i> of bar", "holistic grains and foo of bar.", True),
        ("&quot;How volimostat shapes aquifers&quot;", "How volimostat shpaes aquifers", True),
        ("Evidence fom peraodic genomes in wells", "Evidence from periodic genomes in wells", True),
        ("On the origin of grains Part I", "On the origin of grains Part II", False),
        ("On the origin of grains", "On the origin of grains Part II", False),
        ("Evidence from thermal crops", "Evidence from thermal flows", False),
        ("Clustering", "Clustering of lamolamer in tracers", False),
        ("", "", False),
        (None, "x", False),
    ],
)
def test_titles(a, b, same):
    assert titles.same_title(titles.title_words(a), titles.title_words(b)) is same


WORKS = "id string, doi string, title string, display_name string, publication_year string, publication_date string, updated_date string, batch_no int, cls string"


def works(spark, rows):
    return spark.createDataFrame([(i, d, t, None, y, None, "2023-01-01", b, "x") for i, d, t, y, b in rows], WORKS)


def test_repeated_records(spark):
    w = works(
        spark,
        [
            ("W1", "10.0320/a.1", "Effects of zelolane on coastal grains", "2020", 0), ("W2", None, "Notes for recurrent accounts of valivogen", "2018", 0),
            ("1", None, "another title", "2020", 1), ("3", "doi:10.0320/A.1", "Clustering", "2001", 1), ("4", None, "Notes for recurent accounts of valivogen", "2019", 1),
            ("5", "10.0320/b.2", "Notes for recurrent accounts of valivogen", "2018", 2), ("6", None, "Notes for recurrent accounts of valivogen", "2021", 2),
            ("7", "10.0320/c.3", "Effects of zelolane on coastal grains", "2020", 2), ("8", None, None, None, 2), ("9", None, None, None, 2), ("9", None, None, None, 2),
            (None, None, "Effects of zelolane on coastal grains", "2020", 2), ("10", "10.0320/b.2", "x", "1999", 3),
        ],
    )
    a = spark.createDataFrame(
        [
            ("1", "Oscar Plesingura", None, "7", None, 0, "2023-01-01"), ("2", "O. Plesingura", None, "7", None, 1, "2023-01-01"), ("1", "Oscar X. Plesingura", None, "7", None, 2, "2023-01-01"),
            ("3", "Oscar Plesingurra", None, "7", None, 2, "2023-01-01"), ("4", "Oscar Plesingura", None, "8", None, 2, "2023-01-01"), ("5", "Anna Zubokrira", None, "9", None, 2, "2023-01-01"), ("6", "Anna Zubokrira", None, "9", None, 2, "2023-01-01"),
        ],
        "id string, display_name string, display_name_alternatives string, last_known_institution string, orcid string, batch_no int, updated_date string",
    )
    got = {tuple(r) for r in incremental.repeated_records(w, a).collect()}
    assert got == {
        ("works", 1, "1", "1"), ("works", 1, "1", "3"), ("works", 1, "2", "4"), ("works", 2, "2", "5"), ("works", 3, "10", "5"),
        ("authors", 1, "1", "2"), ("authors", 2, "1", "1"), ("authors", 2, "1", "3"),
    }


def test_chains_of_four(spark):
    """Neighbours of a chain share one institution; its ends share nothing."""
    w = works(spark, [("1", None, "t", "2020", 0)]).limit(0)
    name, other = "Oscar Plesingura", "Anna Zubokrira"
    rows = [
        # in the history: 1~2~3~4 through ORCIDs and institutions; then 5 matches 4 only
        ("1", name, None, "71", None, 0, "2020-01-01"), ("2", "O. Plesingura", None, "71", "0000-0001-0000-0001", 0, "2021-01-01"), ("3", name, None, "72", "0000-0001-0000-0001", 0, "2022-01-01"),
        ("4", "O. Plesingura", None, "72", "0000-0001-0000-0002", 0, "2023-01-01"), ("5", name, None, "73", "0000-0001-0000-0002", 1, "2024-01-01"),
        # in one batch: 12~13~14, of which only 14 matches the older 11
        ("11", other, None, "81", None, 0, "2020-01-01"), ("12", other, None, "83", None, 1, "2024-01-01"), ("13", "A. Zubokrira", None, "83", "0000-0001-0000-0003", 1, "2024-01-01"),
        ("14", other, None, "81", "0000-0001-0000-0003", 1, "2024-01-01"),
        # 22 is joined to the earlier 21 by 23; 24 matches 25, which only 22 knew
        ("21", "Ivo Marenkil", None, "91", None, 0, "2020-01-01"), ("25", "I. Marenkil", None, "92", "0000-0001-0000-0004", 0, "2020-01-03"), ("22", "Ivo Marenkil", None, "93", "0000-0001-0000-0004", 0, "2020-01-02"),
        ("23", "I. Marenkil", None, "91", "0000-0001-0000-0005", 1, "2024-01-01"), ("26", "Ivo Marenkil", None, "93", "0000-0001-0000-0005", 1, "2024-01-01"), ("24", "Ivo Marenkil", None, "92", None, 2, "2024-02-01"),
    ]
    a = spark.createDataFrame(rows, "id string, display_name string, display_name_alternatives string, last_known_institution string, orcid string, batch_no int, updated_date string")
    got = {tuple(r)[1:] for r in incremental.repeated_records(w, a).collect()}
    assert got == {(1, "1", "5"), (1, "11", "12"), (1, "11", "13"), (1, "11", "14"), (1, "21", "23"), (1, "21", "26"), (2, "21", "24")}


def numbered(spark, rows):
    return incremental.with_class(incremental.work_features(works(spark, rows)))


def test_short_titles_with_slips_meet(spark):
    """One word, two words, split words: what matches always becomes a candidate."""
    pairs = [("Immunology", "Immunolgy"), ("Oceanography", "Oceanogrpahhy"), ("Ants", "Antz"), ("Ion channels", "Ion chanels"), ("Hydro dynamics of ponds", "Hydrodynamics of ponds"), ("Hydrodynamics", "Hydro dynamics"), ("A b f e k g h n o j", "A b p e k q h n r j"), ("of of of", "of of off")]
    rows = [(str(100 + i), None, a, "2020", 0) for i, (a, _) in enumerate(pairs)] + [(str(200 + i), None, b, "2021", 1) for i, (_, b) in enumerate(pairs)] + [("300", None, "ab" * 2500, "2020", 0), ("301", None, "ab" * 1500 + "y" + "ab" * 1000, "2020", 1)]
    a = authors(spark, [("1", "x", None, None, None)]).limit(0)
    got = {(r.id_a, r.id_b) for r in incremental.repeated_records(works(spark, rows), a).collect()}
    assert got == {(str(100 + i), str(200 + i)) for i in range(len(pairs))} | {("300", "301")}


@pytest.mark.parametrize("size", [4, 7, 8, 12, 22, 23, 24, 26, 27, 60])
def test_words_within_slips_share_a_token(size):
    rng = random.Random(size)
    slips = 2 if size >= 8 else 1
    for _ in range(60):
        w = "".join(rng.choice("abcde") for _ in range(size))
        v = list(w)
        for _ in range(slips):
            at, kind = rng.randrange(max(len(v) - 1, 1)), rng.randrange(4)
            if kind == 0:
                v[at] = rng.choice("xyz")
            elif kind == 1:
                del v[at]
            elif kind == 2:
                v.insert(at, rng.choice("xyz"))
            else:
                v[at], v[at + 1 if at + 1 < len(v) else at] = v[at + 1 if at + 1 < len(v) else at], v[at]
        v = "".join(v)
        if titles.slips(w, v, slips) <= slips:
            for x, y in ((w, v), (v, w)):
                assert incremental.slip_tokens(x, slips)[0] & incremental.slip_tokens(y, slips)[1]


def test_the_index_opens_again(spark, tmp_path):
    """Another object, as in another process, adds a batch to what stands and reads only its buckets."""
    path = f"{tmp_path}/index"
    rng = random.Random(8)
    first = [(str(i), None, "Notes on " + " ".join("".join(rng.choice("aeghknorst") for _ in range(7)) for _ in range(6)), "2020", 0) for i in range(40)]
    slipped = first[7][2][:-1] + "z"
    later = [("90", None, slipped, "2020", 1), ("3", None, "other", "2020", 1)]
    assert incremental.IncrementalIndex(spark, path, buckets=64).add(numbered(spark, first), 0).count() == 0
    again = incremental.IncrementalIndex(spark, path)
    assert (again.buckets, again.batches) == (64, [0])
    assert {(r.batch_no, r.id_a, r.id_b) for r in again.add(numbered(spark, later), 1).collect()} == {(1, "3", "3"), (1, "7", "90")}
    assert 0 < len(again.touched["postings"]) < 40 and len(again.touched["registry"]) < 10 and len(again.touched["nodes"]) <= 2
    with pytest.raises(ValueError):
        again.add(numbered(spark, later), 1)
    third = incremental.IncrementalIndex(spark, path)
    assert third.batches == [0, 1]
    (tmp_path / "index" / "state" / "batch-1.json").unlink()  # a run lost before its end does not count, and is written anew
    lost = incremental.IncrementalIndex(spark, path)
    assert lost.batches == [0] and lost.add(numbered(spark, later), 1).count() == 2
    assert third.add(numbered(spark, [("91", None, slipped, "2020", 2)]), 2).first().id_a == "7"


def test_no_index_is_left_behind(spark):
    from lorewright.session import shared_dir

    with incremental.IncrementalIndex(spark) as index:
        got = index.add(numbered(spark, [("1", None, "t", "2020", 0)]), 0)
        folder = index.path.replace("file://", "")
        assert os.path.isdir(folder) and index.path.startswith(shared_dir(spark))
    assert not os.path.exists(folder) and got.count() == 0


def test_no_records(spark):
    w = works(spark, [("1", None, "t", "2020", 0)]).limit(0)
    a = authors(spark, [("1", "x", None, None, None)]).limit(0)
    assert incremental.repeated_records(w, a).count() == 0


# --- leakage ----------------------------------------------------------------------------


def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: text(60) for i in range(6)}
    question = "Which statement follows from the passage?"
    docs = {
        1: text(50) + items[0] + text(50),
        2: text(30) + items[1][20:40] + text(30),
        3: text(30) + items[2][5:17] + text(30),
        4: text(40) + [w if k % 10 else "altered" for k, w in enumerate(items[3])] + text(9),
        5: text(20) + rng.sample(items[0], 60) + text(20),
        6: text(20) + items[4][:14] + text(25) + items[4][14:30] + text(20),
        7: text(90) + question.split(),
    }
    return {i: " ".join(x) + ". " + question for i, x in items.items()}, {d: " ".join(x) for d, x in docs.items()}


def test_leaks(spark):
    items, docs = corpus()
    docs[8] = "<p>" + docs[1].upper().replace(" W", ",\n<b>W</b> ".replace("<b>W</b> ", "W")) + "</p>"
    docs[9] = docs[2]
    docs[10], docs[11] = None, ""
    items[6], items[7], items[8] = None, "", items[0]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs.items()], "doc_id bigint, text string, item_id string")
    it = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    want = {(1, 0), (1, 8), (2, 1), (4, 3), (6, 4), (8, 0), (8, 8), (9, 1)}
    for shard, block in ((400_000, 2_000_000), (150, 60)):
        leaks = leakage.find_leaks(df, it, shard_words=shard, block_words=block)
        assert {(r.doc_id, r.item_id) for r in leaks.collect()} == want
    assert {r.doc_id for r in leakage.remove_leaked(df, leaks).collect()} == {3, 5, 7, 10, 11}
    assert {r.item_id: r.documents for r in leakage.item_report(leaks).collect()} == {0: 2, 8: 2, 1: 2, 3: 1, 4: 1}
    assert leakage.find_leaks(df.limit(0), it).count() == 0 and leakage.find_leaks(df, it.limit(0)).count() == 0


def test_words():
    assert leakage.words("Grau-\nvolite &amp; <b>Été</b>, don&#39;t") == ["grauvolite", "ete", "don", "t"]
    assert leakage.words(None) == leakage.words("") == []


def test_suffix_ranges_against_scanning():
    import numpy as np

    rng = np.random.default_rng(3)
    text = np.append(rng.integers(1, 4, 300), -1)
    order = leakage.suffix_array(text, 300)
    assert order.tolist() == sorted(range(300), key=lambda p: text[p:].tolist())
    twice = np.concatenate([text[:40], [-1] * 9, text[:40], [-1]])  # repeated texts, unknown words between
    known = leakage.suffix_array(twice, 64)
    assert set(known.tolist()) == set(np.flatnonzero(twice > 0).tolist())
    runs = [next(k for k in range(41) if twice[p + k] < 0) for p in known]
    assert [twice[p : p + k].tolist() for p, k in zip(known, runs)] == sorted(twice[p : p + k].tolist() for p, k in zip(known, runs))
    for q in rng.integers(1, 4, (40, 4)):
        lo, hi = leakage._equal_range(text, order, q[None, :])
        assert sorted(order[lo[0] : hi[0]].tolist()) == [p for p in range(297) if (text[p : p + 4] == q).all()]


@pytest.mark.parametrize("block", [200, 1500, 2_000_000])
def test_leaks_do_not_depend_on_the_block(spark, block):
    """A question that many items share is no leak, however few of them share a block; a verbatim piece always is one."""
    rng = random.Random(1)
    words = lambda n: " ".join(f"v{rng.randrange(9000)}" for _ in range(n))
    question = "Which of the following statements about the passage given above is best supported by what its author says and by what the survey has found so far?"
    items = [(i, f"{words(40)}. {question}") for i in range(30)] + [(99, words(40))]
    docs = [(1, f"{words(50)}. {question}"), (2, f"{words(9)} {' '.join(items[3][1].split()[5:23])} {words(9)}"), (3, f"{words(9)} {' '.join(items[4][1].split()[5:22])} {words(9)}"), (4, items[30][1])]
    leaks = leakage.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), block_words=block)
    assert sorted((r.doc_id, r.item_id, r.matched) for r in leaks.collect()) == [(2, 3, 18), (4, 99, 40)]


# --- truncation ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "ending"),
    [
        ("It ends here.", "whole"), ("Does it?", "whole"), ("He said “yes.”", "whole"), ("<p>It ends.</p>", "whole"), ("It works (see also X).", "whole"), ("Held at 10.", "whole"),
        ("It stops here. And then it sto", "open"), ("It stops. And then the", "open"), ("It stops. And then,", "open"), ("It fell to 0.", "broken"), ("It differs (p = 0.", "broken"),
        ("It stops. And th...", "broken"), ("It stops. And th…", "broken"), ("It stops. And [...]", "broken"), ("It stops. And (more)", "broken"), ("It stops. And [cont", "broken"),
        ("It stops. A <su", "broken"), ("It stops. A &am", "broken"), ("It stops. A \\u00", "broken"), ("It stops. A (see also", "broken"), ("It stops. A �", "broken"),
        ("It ends.\n\nKeywords: a; b; c", "closing"), ("It ends. Received 8 May 1990; accepted 25 July 2015", "closing"), ("It ends.\nn = 632; p < 0.05", "closing"),
        ("It ends. Trial registration no. KG-46976", "closing"), ("It ends.\nIngulfo A (1977) Effects of x on y, 49(3), 66–184", "closing"), ("It ends. https://x.example/data/8", "closing"),
        ("It ends.\n\n© 2020 The Authors", "closing"), ("It ends.\n— B. Jesiffe, editor", "closing"), ("It ends. And so does this (in press)", "closing"), ("It ends:\n- one\n- two of them", "listed"),
        ("Topics in the field of neural netw", "open"), ("It ends. Smith, J. (2020) found that the eff", "open"), ("It ends. Received wisdom of 1990 says that the eff", "open"), ("It ends. Figure 3 shows that the eff", "open"),
        ("Topics: a, b", "closing"), ("It ends. Figure 3", "closing"), ("He said “it ends.", "broken"), ("It ends. <b>And so.", "broken"), ("<p>One.</p><p>Two.", "broken"), ("<p>One.<p>Two.", "whole"),
        ('He said "it ends.', "broken"), ('He said "it ends."', "whole"), ("A 5\" pipe ends.", "whole"), ("Er sagte „es endet.“", "whole"), ("Il dit « fini ».", "whole"), ("“One.\n\n“Two.”", "whole"), ("It ends (as if.", "whole"),
        ("(" * 30 + "a]" * 30 + ")" * 30 + " ends.", "whole"), ("<i " + "x" * 900 + ">It</i> ends.", "whole"), ("It ends.\nKeywords: " + "word; " * 300 + "x", "closing"), ("It ends. It goes (on. And then it sto", "open"),
        (None, None), ("", None), ("  \n", None),
    ],
)
def test_endings(text, ending):
    assert truncation.judge(text) == ending


def test_titles_can_break(spark):
    assert truncation.judge("On the origin of grains", True) == "listed"
    assert all(truncation.judge(t, True) == "broken" for t in ("On the ori...", "On the origin (of gr", "On the origin &am", "On <i>the ori"))


@pytest.mark.parametrize(("at_limit", "cut"), [(2, 0), (30, 30)])
def test_field_limits(spark, at_limit, cut):
    """A source without full stops cuts at 120 characters: many texts fill the field."""
    rng = random.Random(at_limit)
    rows = [(i, "plain", "abstract", "It ends well. Really" + "x" * rng.randrange(20, 99)) for i in range(200)] + [(1000 + i, "plain", "abstract", "It ends well. " + f"{i:0106}") for i in range(at_limit)]
    marked = truncation.truncated(truncation.endings(spark.createDataFrame(rows, "doc_id bigint, source string, doc_kind string, text string")))
    assert {r.doc_id for r in marked.where("truncated").collect()} == {1000 + i for i in range(cut)}


def test_truncated(spark):
    rows = [(i, "plain", "abstract", "It ends well. Really") for i in range(30)] + [(100, "plain", "abstract", "It ends. And th..."), (101, "good", "abstract", "It stops. And then it"), (102, "good", "title", "On the origin of grains")]
    rows += [(200 + i, "good", "abstract", "It ends.") for i in range(30)] + [(300, None, None, "It stops. And then it"), (301, "good", "abstract", None), (302, "good", "abstract", "x " * 500_000 + ".")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, source string, doc_kind string, text string, ending2 string")
    marked = truncation.truncated(truncation.endings(df))
    assert {r.doc_id for r in marked.where("truncated").collect()} == {100, 101, 300}  # the plain source writes no full stops
    report = {r.source: (r.texts, r.truncated_texts) for r in truncation.source_report(marked).collect()}
    assert report == {"plain": (31, 1), "good": (33, 1), None: (1, 1)}
    assert truncation.truncated(truncation.endings(df.limit(0))).count() == 0


# --- queries --------------------------------------------------------------------------------


def llm_names():
    from lorewright.llm.queries import LLM

    return list(LLM.queries)


def bare(c):
    return f"nullif(regexp_extract(coalesce({c},''),'([0-9]+)\\s*$',1),'')"


def properties(spark, con, sf):
    """What must hold of the rows of every query that has no SQL."""
    from lorewright.llm.queries import LLM

    q = lambda sql: {tuple(r) for r in con.execute(sql).fetchall()}
    run = lambda name: [tuple(r) for r in LLM.queries[name](spark, sf).collect()]
    docs = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())

    def p2_found(rows):
        """The repetitions under the same id are those of SQL; the others pair a new id with an older one."""
        parts = [f"SELECT '{e}' AS e, {bare('id')} AS id, batch_no AS b FROM {e}" for e in ("works", "authors")]
        seen = q(f"WITH r AS ({' UNION ALL '.join(parts)}) SELECT DISTINCT x.e, x.b, x.id, x.id FROM r x JOIN r y ON x.e=y.e AND x.id=y.id AND y.b<x.b WHERE x.id IS NOT NULL")
        first = {(e, i): b for e, i, b in q(f"SELECT e, id, min(b) FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL")}
        others = [r for r in rows if r[2] != r[3]]
        return {r for r in rows if r[2] == r[3]} == seen and len(others) > 2 and all(a < b and {first[e, a], first[e, b]} != {n} and n in (first[e, a], first[e, b]) for e, n, a, b in others)

    def p5_found(rows):
        """Recall against brute force over all vectors, and no pair below the floor."""
        import numpy as np

        from lorewright.llm import neighbors

        v = spark.read.parquet(f"{sf}/works_vector.parquet").selectExpr("regexp_extract(work_id, '([0-9]+)[ ]*$', 1) AS w", "vec")
        units = sorted((r.key, r.unit) for r in neighbors.unit_vectors(v.where("w <> ''"), "w", "vec", 384).collect())
        keys, u = [k for k, _ in units], np.array([x for _, x in units], dtype=np.float64)
        s = u @ u.T
        np.fill_diagonal(s, -2)
        want = {(min(keys[i], keys[j]), max(keys[i], keys[j])) for i in range(len(keys)) for j in np.argsort(-s[i])[:5] if s[i, j] >= 0.8}
        at = {k: i for i, k in enumerate(keys)}
        return len(want & set(rows)) >= 0.9 * len(want) and all(s[at[a], at[b]] >= 0.8 - 1e-6 for a, b in rows)

    def p7_found(rows):
        """All pairs that bear one written name in one institution are there, and the pairs are closed."""
        names_ = f"SELECT DISTINCT {bare('id')} AS id, display_name AS n, {bare('last_known_institution')} AS i FROM authors"
        must = q(f"WITH a AS ({names_}) SELECT DISTINCT x.id, y.id FROM a x JOIN a y ON x.n=y.n AND x.i=y.i AND x.id<y.id WHERE trim(x.n) LIKE '% %'")
        near = {}
        for a, b in rows:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
        return len(rows) == len(set(rows)) and must <= set(rows) and all(near[x] - {y} == near[y] - {x} for x, y in rows)

    def p8_containers(rows):
        """No container holds more than its capacity, no document is lost or needlessly split."""
        load, parts = {}, {}
        for doc, copy, _, tokens, container, free in rows:
            load[container] = load.get(container, 0) + tokens
            assert tokens + free <= 2048
            parts.setdefault((doc, copy), []).append(tokens)
        full = {k for k, t in docs.items() if t and t.strip()}
        return max(load.values()) <= 2048 and {d for d, _ in parts} == full and all(len(p) == 1 or sum(p) > 2048 for p in parts.values())

    def p9_found(rows):
        """Every item whose 18 words in a row stand verbatim in a document is reported for it."""
        items = dict(con.execute("SELECT item_id, text FROM eval_items").fetchall())
        shared = leakage.shared_closings(spark.read.parquet(f"{sf}/eval_items.parquet"))
        pieces = {}
        for i, t in items.items():
            ws = leakage.passage(t, shared)
            for k in range(len(ws) - 17):
                pieces.setdefault(" ".join(ws[k : k + 18]), set()).add(i)
        must = set()
        for d, t in docs.items():
            ws = leakage.words(t)
            for k in range(len(ws) - 17):
                must.update((d, i) for i in pieces.get(" ".join(ws[k : k + 18]), ()))
        return must <= set(rows) and len(must) >= 0.5 * len(rows)

    return {
        "p2_found": p2_found,
        "p2_report": lambda rows: sum(r[2] + r[3] for r in rows) == len(run("p2_found")) > 0,
        "p5_found": p5_found,
        "p5_neighbors": lambda rows: len(rows) > 0 and all(-1.000001 <= r[2] <= 1.000001 and 1 <= r[3] <= 5 for r in rows),  # against brute force in test_neighbors_however_far
        "p7_found": p7_found,
        "p7_clusters": lambda rows: sum(r[2] - 1 for r in rows) == 2 * len(run("p7_found")) and all(r[3] >= 1 for r in rows),
        "p8_containers": p8_containers,
        "p8_fill": lambda rows: len(rows) == 1 and rows[0][3] <= rows[0][2] <= 1.05 * rows[0][3] + 1,
        "p9_found": p9_found,
        "p9_items": lambda rows: sum(r[1] for r in rows) == len(run("p9_found")) and all(r[2] >= 12 for r in rows),
        "p9_clean": lambda rows: {r[0] for r in rows} == set(docs) - {r[0] for r in run("p9_found")},
        "p10_found": lambda rows: 0 < len(rows) < 0.3 * len(docs) and all(truncation.judge(docs[r[0]]) in ("open", "broken") for r in rows),
        "p10_sources": lambda rows: sum(r[2] for r in rows) >= len(run("p10_found")) > 0 and sum(r[1] for r in rows) == sum(bool(t and t.strip()) for t in docs.values()),
    }


@pytest.mark.parametrize("name", llm_names())
def test_query(spark, sf, name):
    pytest.importorskip("duckdb")
    from tools_oracle import compare, connect

    from lorewright.llm.queries import LLM

    con = connect(sf)
    if name in LLM.sql:
        said = compare(spark, con, name, sf)
        assert said.startswith("ok"), said
    else:
        assert properties(spark, con, sf)[name]([tuple(r) for r in LLM.queries[name](spark, sf).collect()])
