"""Nested snapshot records to flat tables.

Each function takes parsed records (see ``sources.snapshots``) and returns lazy
frames with the columns of ``schemas.FLAT_COLUMNS``.  Array fields of works are
held as JSON text and parsed here, because a source may write a list, ``null``
or one bare object.  All explodes are null-safe: a record with a broken part
keeps its other parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.schemas import AUTHORSHIP_DDL, FLAT_COLUMNS, TOPIC_LINK_DDL


def _bool_text(c: Column) -> Column:
    """``True``/``False`` as text, the written form of flags in flat tables."""
    return F.initcap(c.cast("string"))


def _listed(c: Column, ddl: str) -> Column:
    """JSON text as an array; one bare object is an array of one."""
    s = F.trim(c)
    return F.when(s.startswith("{"), F.from_json(F.concat(F.lit("["), s, F.lit("]")), ddl)).otherwise(F.from_json(s, ddl))


def _not_blank(c: Column) -> Column:
    return F.length(F.trim(F.coalesce(c, F.lit("")))) > 0


def _side_ids(r: DataFrame, table: str, catalogue: str | None) -> DataFrame:
    """One row per record that has ids; ``catalogue`` names the catalogue's own id field, placed after the key."""
    key, *names = FLAT_COLUMNS[table]
    if catalogue:
        names = [catalogue, *names]
    return r.where("ids IS NOT NULL").select(F.col("id").alias(key), *[F.try_element_at("ids", F.lit(n)).alias(n) for n in names])


def _project(df: DataFrame, table: str, *places: str) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in FLAT_COLUMNS[table]], *places)


def flatten_works(records: DataFrame, authorship_mode: str = "all", ordinals: bool = False) -> dict[str, DataFrame]:
    """works, works_authorships, works_topics, works_referenced_works, works_biblio.

    ``authorship_mode='all'`` gives one row per non-blank institution and one
    with NULL where there is none, and drops authorships without an author;
    ``'first'`` gives one row per authorship with its first institution and
    keeps rows without an author.  With ``ordinals`` the link tables also say
    where an element stood: ``item_pos`` and, for institutions,
    ``institution_pos`` (the place among the non-blank ones).
    """
    r = records.select("_record.*")
    links = r.select(
        F.col("id").alias("work_id"),
        _listed(F.col("authorships"), AUTHORSHIP_DDL).alias("a"),
        _listed(F.col("topics"), TOPIC_LINK_DDL).alias("t"),
        F.from_json("referenced_works", "array<string>").alias("w"),
    )
    ships = links.select("work_id", F.posexplode("a").alias("item_pos", "a"))
    place = ["item_pos"] if ordinals else []
    if authorship_mode == "first":
        ships = ships.withColumns({"institution_pos": F.lit(0), "institution_id": F.get("a.institutions", 0)["id"]})
    elif authorship_mode == "all":
        ships = ships.where(_not_blank(F.col("a.author.id"))).select("*", F.posexplode_outer(F.filter(F.col("a.institutions.id"), _not_blank)).alias("institution_pos", "institution_id"))
    else:
        raise ValueError(authorship_mode)
    works = r.select(
        *[c for c in FLAT_COLUMNS["works"] if c not in ("is_retracted", "is_paratext")],
        _bool_text(F.col("is_retracted")).alias("is_retracted"),
        _bool_text(F.col("is_paratext")).alias("is_paratext"),
    )
    return {
        "works": _project(works, "works"),
        "works_authorships": _project(
            ships.select("work_id", "a.author_position", F.col("a.author.id").alias("author_id"), "institution_id", "a.raw_affiliation_string", "item_pos", "institution_pos"),
            "works_authorships",
            *place,
            *(["institution_pos"] if ordinals else []),
        ),
        "works_topics": _project(
            links.select("work_id", F.posexplode("t").alias("item_pos", "t")).select("work_id", "item_pos", "t.*").where(_not_blank(F.col("id"))).withColumnRenamed("id", "topic_id"), "works_topics", *place
        ),
        "works_referenced_works": _project(
            links.select("work_id", F.posexplode("w").alias("item_pos", "referenced_work_id")).where(_not_blank(F.col("referenced_work_id"))),
            "works_referenced_works",
            *place,
        ),
        "works_biblio": _project(r.where("biblio IS NOT NULL").select(F.col("id").alias("work_id"), "biblio.*"), "works_biblio"),
    }


def flatten_authors(records: DataFrame, catalogue: str | None = None) -> dict[str, DataFrame]:
    """authors, authors_ids, authors_counts_by_year.

    ``catalogue`` is the field of ``ids`` under which the catalogue gives its
    own id; with it authors_ids has that column too.
    """
    r = records.select("_record.*")
    authors = r.withColumns(
        {
            "display_name_alternatives": F.coalesce(F.to_json("display_name_alternatives"), F.lit("null")),
            "last_known_institution": F.col("last_known_institution.id"),
        }
    )
    return {
        "authors": _project(authors, "authors"),
        "authors_ids": _side_ids(r, "authors_ids", catalogue),
        "authors_counts_by_year": _project(r.select(F.col("id").alias("author_id"), F.inline("counts_by_year")), "authors_counts_by_year"),
    }


def flatten_topics(records: DataFrame, keyword_separator: str = "; ") -> dict[str, DataFrame]:
    """topics; ``updated`` stands in where ``updated_date`` is missing."""
    r = records.select("_record.*")
    flat = {f"{level}_{part}": F.col(f"{level}.{part}") for level in ("subfield", "field", "domain") for part in ("id", "display_name")}
    topics = r.withColumns(
        flat
        | {
            "keywords": F.array_join("keywords", keyword_separator),
            "wikipedia_id": F.col("ids.wikipedia"),
            "updated_date": F.coalesce("updated_date", "updated"),
        }
    )
    return {"topics": _project(topics, "topics")}


def flatten_institutions(records: DataFrame, catalogue: str | None = None) -> dict[str, DataFrame]:
    """institutions, institutions_ids, institutions_geo; ``catalogue`` as for authors."""
    r = records.select("_record.*")
    lists = {c: F.coalesce(F.to_json(c), F.lit("null")) for c in ("display_name_acronyms", "display_name_alternatives")}
    return {
        "institutions": _project(r.withColumns(lists), "institutions"),
        "institutions_ids": _side_ids(r, "institutions_ids", catalogue),
        "institutions_geo": _project(r.where("geo IS NOT NULL").select(F.col("id").alias("institution_id"), "geo.*"), "institutions_geo"),
    }


FLATTENERS = {"works": flatten_works, "authors": flatten_authors, "topics": flatten_topics, "institutions": flatten_institutions}
