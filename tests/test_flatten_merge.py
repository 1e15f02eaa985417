"""Flattening, merging, mapping, sources: micro-fixtures and properties."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from lorewright.operators import collaboration, flatten, mapping, merge, vectors
from lorewright.sources import flat, snapshots

WORK = {
    "id": "https://x/W1",
    "title": 'a "q"\nb\\',
    "is_retracted": False,
    "authorships": [
        {"author_position": "first", "author": {"id": "A1"}, "institutions": []},
        {"author_position": "last", "author": {"id": "A2"}, "institutions": [{"id": "I1"}, {"id": ""}, {"id": "I2"}]},
        {"author_position": "middle", "author": None, "institutions": [{"id": "I9"}]},
    ],
    "topics": {"id": "T1", "score": 0.5},
    "referenced_works": ["W2", "", None, "W3"],
    "biblio": {"volume": "1"},
}


def records(spark, *lines, entity="works"):
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    return snapshots.parse_lines(df, entity)


def test_flatten_works(spark):
    r = records(spark, json.dumps(WORK), "", "  ", "{broken", '{"id": ""}')
    t = flatten.flatten_works(r)
    rows = {k: sorted(tuple(x) for x in v.collect()) for k, v in t.items() if k != "works_authorships"}
    assert [x[0] for x in rows["works"]] == ["https://x/W1"]
    assert rows["works_topics"] == [("https://x/W1", "T1", "0.5")]
    assert [x[1] for x in rows["works_referenced_works"]] == ["W2", "W3"]
    assert rows["works_biblio"] == [("https://x/W1", "1", None, None, None)]
    every = sorted((x.author_id, x.institution_id) for x in t["works_authorships"].collect())
    assert every == [("A1", None), ("A2", "I1"), ("A2", "I2")] or every == sorted([("A1", None), ("A2", "I1"), ("A2", "I2")], key=str)
    first = [(x.author_id, x.institution_id) for x in flatten.flatten_works(r, "first")["works_authorships"].collect()]
    assert first == [("A1", None), ("A2", "I1"), (None, "I9")]
    with pytest.raises(ValueError):
        flatten.flatten_works(r, "other")


def test_flatten_other_entities(spark):
    a = records(spark, json.dumps({"id": "A1", "display_name_alternatives": ["x"], "last_known_institution": {"id": "I"}, "ids": {"mag": "7"}, "counts_by_year": [{"year": 2020, "works_count": 3}]}), entity="authors")
    t = flatten.flatten_authors(a)
    assert t["authors"].first().last_known_institution == "I"
    assert t["authors_ids"].first().mag == "7" and "own" not in t["authors_ids"].columns
    assert flatten.flatten_authors(a, "own")["authors_ids"].columns[:2] == ["author_id", "own"]
    assert tuple(t["authors_counts_by_year"].first())[:3] == ("A1", "2020", "3")
    topic = records(spark, json.dumps({"id": "T", "keywords": ["a", "b"], "subfield": {"id": "s"}, "updated": "2024-01-01", "extra": 1}), entity="topics")
    row = flatten.flatten_topics(topic)["topics"].first()
    assert (row.keywords, row.subfield_id, row.updated_date, row.field_id) == ("a; b", "s", "2024-01-01", None)
    i = records(spark, json.dumps({"id": "I", "geo": {"city": "c", "latitude": 1.5}}), entity="institutions")
    t = flatten.flatten_institutions(i)
    assert (t["institutions_geo"].first().latitude, t["institutions_ids"].count(), t["institutions"].first().display_name_acronyms) == ("1.5", 0, "null")


def test_net_new(spark):
    inc = spark.createDataFrame([("1",), ("1",), ("2",), ("2",), ("",), (None,)], "id string")
    full = spark.createDataFrame([("1",), ("",)], "id string")
    assert [r.id for r in merge.net_new(inc, full, ["id"]).collect()] == ["2", "2"]
    assert merge.net_new(inc, None, ["id"]).count() == 6
    assert merge.net_new(inc, full.unionByName(inc), ["id"]).count() == 0
    other = spark.createDataFrame([("1", "x")], "startid string, endid string")
    two = spark.createDataFrame([("1", "x"), ("1", "y")], "work_id string, referenced_work_id string")
    left = merge.net_new(two, other, ["work_id", "referenced_work_id"], {"work_id": "startid", "referenced_work_id": "endid"})
    assert [tuple(r) for r in left.collect()] == [("1", "y")]
    assert tuple(merge.merge_stats(inc, full, ["id"]).first()) == (6, 2, 4, 66.6667)
    assert tuple(merge.merge_stats(inc.limit(0), full, ["id"]).first()) == (0, 0, 0, 0.0)
    assert tuple(merge.key_stats(inc, ["id"]).first()) == (6, 3, 3)


def test_first_wins_and_shards(spark):
    df = spark.createDataFrame([("1", 2, "b"), ("1", 1, "c"), ("1", 1, "a"), ("2", 1, "z")], "id string, o int, v string")
    assert sorted(tuple(r) for r in merge.first_wins(df, ["id"], ["o"]).collect()) == [("1", 1, "a"), ("2", 1, "z")]
    h = {r.shard: r["rows"] for r in merge.shard_histogram(df, ["id"]).collect()}
    assert sum(h.values()) == 4 and all(0 <= k < 100 for k in h)


def test_vertices_and_edges(spark):
    df = spark.createDataFrame([("1", "n", None)], "id string, display_name string, works_count string")
    v = mapping.vertices(df, "authors").first()
    assert json.loads(v.properties) == {"display_name": "n", "works_count": "", "cited_by_count": "0"}
    e = spark.createDataFrame([("w", "t", "0.95"), ("w", "t", ""), ("w", "t", "n/a")], "work_id string, topic_id string, score string")
    assert [json.loads(r.properties) for r in mapping.topic_edges(e).collect()] == [{"score": 0.95}, {}, {"score": "n/a"}]
    r = spark.createDataFrame([("w", " x "), ("w", " "), ("", "x"), (None, "x")], "work_id string, referenced_work_id string")
    assert [tuple(x) for x in mapping.reference_edges(r).collect()] == [("w", "x", "{}")]


def test_documents(spark):
    a = spark.createDataFrame([("1", " o ", "a; b"), ("2", "", "")], "id string, orcid string, display_name_alternatives string")
    docs = [json.loads(r.doc) for r in mapping.author_documents(a).orderBy("id").collect()]
    assert docs == [{"orcid": "o", "display_name_alternatives": ["a", "b"]}, {"display_name_alternatives": []}]
    works = spark.createDataFrame([("1", "d", "en", '{"b":[1],"a":[0]}'), ("2", None, None, None)], "id string, doi string, language string, abstract_inverted_index string")
    ships = spark.createDataFrame([("1", 2, "first", "9", ""), ("1", 1, "", "8", "i"), ("3", 1, "x", "7", "")], "work_id string, ord int, author_position string, author_id string, institution_id string")
    topics = spark.createDataFrame([("1", "t", "0.5")], "work_id string, topic_id string, score string")
    docs = {r.id: json.loads(r.doc) for r in mapping.work_documents(works, ships, topics, order={"authorships": ["ord"]}).collect()}
    assert docs["1"]["abstract"] == "a b"
    assert docs["1"]["authorships"] == [{"author": {"id": "8"}, "institution": {"id": "i"}}, {"author_position": "first", "author": {"id": "9"}}]
    assert docs["1"]["topics"] == [{"id": "t", "score": "0.5"}]
    assert docs["2"] == {"authorships": [], "topics": []}


@pytest.mark.parametrize("block", [1, 2, 400])
def test_collaboration(spark, block):
    rows = [("1", "10", "a"), ("1", "9", ""), ("1", "10", "b"), ("2", "9", ""), ("2", "10", ""), ("2", "11", ""), ("3", "5", "")]
    a = spark.createDataFrame(rows, "work_id string, author_id string, institution_id string")
    w = spark.createDataFrame([("1", "2020"), ("1", "")], "id string, publication_year string")
    e = {(r.startid, r.endid): json.loads(r.properties) for r in collaboration.collaboration_edges(a, w, block=block).collect()}
    assert e[("10", "9")]["cnt"] == 3 and e[("10", "10")]["cnt"] == 1 and e[("11", "9")]["cnt"] == 1
    assert e[("10", "9")]["list"] == [{"year": "", "work_id": "2"}, {"year": "2020", "work_id": "1"}, {"year": "2020", "work_id": "1"}]
    assert sum(x["cnt"] for x in e.values()) == 3 + 3  # n(n-1)/2 of each work
    d = {r.author_id: r.partners for r in collaboration.degree(collaboration.collaboration_edges(a, w, with_list=False, block=block)).collect()}
    assert d == {"9": 2, "10": 2, "11": 2}


def test_vectors(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [4.0, 3.0])], "vec_id int, embedding array<float>")
    unit = {r[0]: r[1] for r in df.select("vec_id", vectors.l2_normalize(F.col("embedding"))).collect()}
    assert unit[1] == pytest.approx([0.6, 0.8]) and unit[2] == [0.0, 0.0]
    top = vectors.cosine_topk(df.where("vec_id = 1"), df, 1).first()
    assert (top.match_id, top.cosine) == (3, 0.96)
    text = spark.createDataFrame([("alpha beta",), ("",), (None,)], "t string")
    v = [r.vec for r in vectors.encode_text(text, F.col("t")).collect()]
    assert [len(x) for x in v] == [384] * 3 and sum(x * x for x in v[0]) == pytest.approx(1, abs=1e-6) and not any(v[1])
    pooled = spark.range(1).select(vectors.mean_pool(F.array(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(9.0), F.lit(9.0))), F.array(F.lit(1.0), F.lit(0.0)), 2)).first()[0]
    assert pooled == [1.0, 2.0]


def test_snapshot_reading(spark, tmp_path):
    for day, i in (("2024-01-05", "1"), ("2024-02-05", "2")):
        p = tmp_path / "works" / f"updated_date={day}"
        p.mkdir(parents=True)
        with gzip.open(p / "part.gz", "wt") as f:
            f.write(json.dumps({"id": i, "updated_date": "own"}) + "\n\n{bad\n")
    root = str(tmp_path)
    assert sorted(r["_record"].id for r in snapshots.read_snapshot(spark, root, "works", "2024-01-06", "LATEST").collect()) == ["2"]
    assert [r["_record"].updated_date for r in snapshots.read_snapshot(spark, root, "works").collect()] == ["own", "own"]
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-03",), ("x",)], "d string")
    assert str(snapshots.nearest_date(days, "d", "2024-01-02").first()[0]) == "2024-01-03"
    assert str(snapshots.nearest_date(days, "d", "bad").first()[0]) == "2024-01-03"
    assert [str(r[0]) for r in snapshots.dates_in_range(days, "d", "2024-01-01", "latest").collect()] == ["2024-01-01", "2024-01-03"]
    (tmp_path / "manifest").write_text("a.gz\n\nb.gz\n")
    listed = snapshots.read_manifest(spark, f"{root}/manifest")
    assert [r[0] for r in snapshots.pending_files(listed, listed.limit(1)).collect()] == ["b.gz"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "q", b\nline2\\'), ("2", ""), ("3", " pad ")], "id string, title string")
    out = str(tmp_path / "t")
    flat.write_flat(df, out, ["id", "title"])
    assert flat.output_exists(spark, out) and not flat.output_exists(spark, out + "x")
    assert sorted(tuple(r) for r in flat.read_flat(spark, out).collect()) == sorted(tuple(r) for r in df.collect())
    with pytest.raises(ValueError):
        flat.write_flat(df, out + "2", ["id"], strict=True)
