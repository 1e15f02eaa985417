"""Scalar expressions against the edge tables of the data contract."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lorewright.functions.ids import bare_doi, bare_id, bare_orcid, normalize_id, normalize_row_ids
from lorewright.functions.text import build_inverted_index, numeric_or_null, parse_alternatives, reconstruct_abstract, title_and_abstract


def apply(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_normalize_id(spark):
    cases = {
        "https://x.org/A5028767461": "5028767461", "https://x.org/W": "https://x.org/W", "https://x.org/": "https://x.org/",
        "https://x.org/123": "https://x.org/123", "A12": "A12", "": "", None: "", "httpfoo": "ttpfoo", "http://x.org/graph/W9": "9",
    }
    assert apply(spark, list(cases), normalize_id) == list(cases.values())


def test_normalize_row_ids_leaves_other_columns(spark):
    df = spark.createDataFrame([("https://x/A1", "https://x/A2", "https://x/A3")], "id string, orcid string, work_id string")
    assert tuple(normalize_row_ids(df).first()) == ("1", "https://x/A2", "3")


def test_bare_id(spark):
    cases = {"2001": "2001", " 2001": "2001", "2001 ": "2001", "https://k.example/W2001": "2001", "": None, "  ": None, None: None, "none": None}
    assert apply(spark, list(cases), bare_id) == list(cases.values())


def test_bare_orcid_and_doi(spark):
    assert apply(spark, ["https://orcid.example/9990-9000-0005-996x", "9990900000059960", "", None, "123"], bare_orcid) == ["999090000005996X", "9990900000059960", None, None, None]
    dois = ["https://doi.example/10.0320/AB.1", "doi:10.0320/ab.1", "10.0320/ab.1", "", None, "x"]
    assert apply(spark, dois, bare_doi) == ["10.0320/ab.1"] * 3 + [None] * 3


def test_alternatives(spark):
    cases = {'["a","b"]': ["a", "b"], "a; b;": ["a", "b"], "a, b": ["a", "b"], "a": ["a"], "": [], None: [], "a, b; c": ["a, b", "c"], '"x"': ["x"], "123": ["123"], "[]": []}
    assert apply(spark, list(cases), parse_alternatives) == list(cases.values())


@pytest.mark.parametrize(
    ("index", "text"),
    [('{"world":[1,7],"hello":[0],"gap":[7]}', "hello world gap"), ("", None), ("bad json", None), (None, None), ("{}", None), ('{"b":[1],"a":[0],"c":[5]}', "a b c")],
)
def test_reconstruct(spark, index, text):
    assert apply(spark, [index], reconstruct_abstract) == [text]


def test_inverted_index_round_trip(spark):
    texts = ["the cat and the hat", "  one   two ", "x", "é ü é"]
    back = apply(spark, texts, lambda c: reconstruct_abstract(F.to_json(build_inverted_index(c))))
    assert back == [" ".join(t.split()) for t in texts]


def test_numbers_and_concatenation(spark):
    assert apply(spark, ["0.95", "", "n/a", "0.5d", "1e-3", " 2 ", None, "1_0"], numeric_or_null) == [0.95, None, None, None, 0.001, 2.0, None, None]
    df = spark.createDataFrame([("t", "a"), (None, "a"), ("t", None), (None, None)], "t string, a string")
    assert [r[0] for r in df.select(title_and_abstract(F.col("t"), F.col("a"))).collect()] == ["t a", "a", "t", ""]
