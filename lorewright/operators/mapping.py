"""Flat tables to graph vertices, edges and documents.

A default stands in only where the column is missing from the table; an empty
cell stays empty.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.functions.ids import strip_all
from lorewright.functions.text import numeric_or_null, omit_empty, parse_alternatives, parse_inverted_index, reconstruct_abstract, text_or_empty, title_and_abstract

#: Properties of each vertex and what stands for a column that the table lacks (fixed values).
VERTEX_PROPERTIES: dict[str, dict[str, str]] = {
    "authors": {"display_name": "", "works_count": "0", "cited_by_count": "0"},
    "works": {"title": "", "publication_year": "", "publication_date": "", "type": "", "cited_by_count": "0", "is_retracted": "False", "is_paratext": "False"},
    "topics": {"display_name": "", "keywords": "", "works_count": "0", "cited_by_count": "0"},
}


def _cell(df: DataFrame, name: str, default: str = "") -> Column:
    return text_or_empty(F.col(f"`{name}`")) if name in df.columns else F.lit(default)


def vertices(df: DataFrame, entity: str) -> DataFrame:
    """``id, properties`` with the properties as JSON text."""
    props = [_cell(df, c, d).alias(c) for c, d in VERTEX_PROPERTIES[entity].items()]
    return df.select(_cell(df, "id").alias("id"), F.to_json(F.struct(*props)).alias("properties"))


def topic_edges(df: DataFrame) -> DataFrame:
    """work to topic; ``score`` is a number where it is one, else text, and left out when empty."""
    s = strip_all(F.col("score"))
    number = numeric_or_null(F.col("score"))
    props = F.when(number.isNotNull(), F.to_json(F.struct(number.alias("score")))).otherwise(F.to_json(F.struct(omit_empty(s).alias("score"))))
    return df.select(_cell(df, "work_id").alias("startid"), _cell(df, "topic_id").alias("endid"), props.alias("properties"))


def authorship_edges(df: DataFrame) -> DataFrame:
    """work to author; ``author_position`` is left out when empty."""
    return df.select(
        _cell(df, "work_id").alias("startid"),
        _cell(df, "author_id").alias("endid"),
        F.to_json(F.struct(omit_empty(F.col("author_position")).alias("author_position"))).alias("properties"),
    )


def reference_edges(df: DataFrame) -> DataFrame:
    """work to referenced work; rows with either end blank are dropped."""
    start, end = strip_all(F.col("work_id")), strip_all(F.col("referenced_work_id"))
    return df.where((start != "") & (end != "")).select(start.alias("startid"), end.alias("endid"), F.lit("{}").alias("properties"))


def author_documents(df: DataFrame) -> DataFrame:
    """``id, doc``: the ORCID when there is one, and the alternatives as an array."""
    doc = F.to_json(
        F.struct(
            F.nullif(strip_all(F.col("orcid")), F.lit("")).alias("orcid"),
            parse_alternatives(F.col("display_name_alternatives")).alias("display_name_alternatives"),
        )
    )
    return df.select(_cell(df, "id").alias("id"), doc.alias("doc"))


def _object(**parts: Column) -> Column:
    """A struct of its non-empty parts; NULL when all are empty."""
    kept = {k: omit_empty(v) for k, v in parts.items()}
    some = F.coalesce(*kept.values()).isNotNull()
    return F.when(some, F.struct(*[v.alias(k) for k, v in kept.items()]))


def authorship_object(df: DataFrame) -> Column:
    return F.struct(
        omit_empty(_cell(df, "author_position")).alias("author_position"),
        _object(id=_cell(df, "author_id"), display_name=_cell(df, "author_display_name")).alias("author"),
        _object(id=_cell(df, "institution_id"), display_name=_cell(df, "institution_display_name")).alias("institution"),
    )


def topic_object(df: DataFrame) -> Column:
    return F.struct(
        omit_empty(_cell(df, "topic_id")).alias("id"),
        omit_empty(_cell(df, "topic_display_name")).alias("display_name"),
        omit_empty(_cell(df, "score")).alias("score"),
    )


def _collected(df: DataFrame, obj: Column, order: list[str], name: str) -> DataFrame:
    """One array per work, in the order of ``order`` and then of the object itself.

    The list of a work is one value of its document, so it is bounded by what a
    document may hold; it is not used for per-key statistics.
    """
    items = df.select(F.col("work_id"), F.struct(*[F.col(c) for c in order], obj.alias("_o")).alias("_s"))
    grouped = items.groupBy("work_id").agg(F.array_sort(F.collect_list("_s")).alias("_l"))
    return grouped.select("work_id", F.transform("_l", lambda x: x["_o"]).alias(name))


def work_documents(works: DataFrame, authorships: DataFrame, topics: DataFrame, biblio: DataFrame | None = None, order: Mapping[str, list[str]] | None = None) -> DataFrame:
    """``id, doi, doc``: left outer join of works with their ordered authorships and topics.

    Works without either have empty arrays.  ``order`` names the ordinal
    columns of the two link tables; those that flattening gives are used where
    the tables have them, so the elements keep the order of the source.
    """
    given = lambda df: [c for c in ("item_pos", "institution_pos") if c in df.columns]
    order = {"authorships": given(authorships), "topics": given(topics), **(order or {})}
    a = _collected(authorships, authorship_object(authorships), order.get("authorships", []), "authorships")
    t = _collected(topics, topic_object(topics), order.get("topics", []), "topics")
    w = works.withColumn("work_id", F.col("id"))
    j = w.join(a, "work_id", "left").join(t, "work_id", "left")
    if biblio is not None:
        j = j.join(biblio.dropDuplicates(["work_id"]), "work_id", "left")
    has_index = "abstract_inverted_index" in works.columns
    index = F.col("abstract_inverted_index") if has_index else F.lit(None).cast("string")
    doc = F.struct(
        omit_empty(_cell(j, "language")).alias("language"),
        omit_empty(reconstruct_abstract(index) if has_index else F.lit("")).alias("abstract"),
        *[omit_empty(_cell(j, c)).alias(c) for c in ("volume", "issue", "first_page", "last_page")],
        F.coalesce("authorships", F.array().cast(a.schema["authorships"].dataType)).alias("authorships"),
        F.coalesce("topics", F.array().cast(t.schema["topics"].dataType)).alias("topics"),
        parse_inverted_index(index).alias("abstract_inverted_index"),
    )
    return j.select(_cell(j, "id").alias("id"), _cell(j, "doi").alias("doi"), F.to_json(doc).alias("doc"))


def work_texts(works: DataFrame) -> DataFrame:
    """Append ``text``, the title and the abstract rebuilt from its inverted index; a table without that column has titles only."""
    abstract = reconstruct_abstract(F.col("abstract_inverted_index")) if "abstract_inverted_index" in works.columns else F.lit("")
    return works.withColumn("text", title_and_abstract(F.col("title"), abstract))
