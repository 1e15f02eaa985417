"""Schemas of the raw nested records and of the flat tables.

The column lists, keys and id columns are fixed values: they are the data
contract of the snapshots and must stay as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- raw nested records, one JSON object per line -------------------------

RAW_DDL: dict[str, str] = {
    "authors": (
        "id string, orcid string, display_name string, display_name_alternatives array<string>, "
        "works_count bigint, cited_by_count bigint, last_known_institution struct<id:string>, "
        "works_api_url string, updated_date string, "
        "ids map<string,string>, "
        "counts_by_year array<struct<year:int,works_count:bigint,cited_by_count:bigint,oa_works_count:bigint>>"
    ),
    "topics": (
        "id string, display_name string, description string, keywords array<string>, works_api_url string, "
        "ids struct<wikipedia:string>, subfield struct<id:string,display_name:string>, "
        "field struct<id:string,display_name:string>, domain struct<id:string,display_name:string>, "
        "works_count bigint, cited_by_count bigint, updated_date string, updated string"
    ),
    "institutions": (
        "id string, ror string, display_name string, country_code string, type string, homepage_url string, "
        "image_url string, image_thumbnail_url string, display_name_acronyms array<string>, "
        "display_name_alternatives array<string>, works_count bigint, cited_by_count bigint, "
        "works_api_url string, updated_date string, "
        "ids map<string,string>, "
        "geo struct<city:string,geonames_city_id:string,region:string,country_code:string,country:string,"
        "latitude:double,longitude:double>"
    ),
    "works": (
        "id string, doi string, title string, display_name string, publication_year int, publication_date string, "
        "type string, cited_by_count bigint, is_retracted boolean, is_paratext boolean, cited_by_api_url string, "
        "language string, updated_date string, abstract_inverted_index string, authorships string, "
        "biblio struct<volume:string,issue:string,first_page:string,last_page:string>, "
        "topics string, referenced_works string"
    ),
}

AUTHORSHIP_DDL = (
    "array<struct<author_position:string,author:struct<id:string>,"
    "institutions:array<struct<id:string>>,raw_affiliation_string:string>>"
)
TOPIC_LINK_DDL = "array<struct<id:string,score:string>>"


def raw_schema(entity: str) -> T.StructType:
    return T._parse_datatype_string(RAW_DDL[entity])  # type: ignore[return-value]


# --- flat tables ------------------------------------------------------------

# The side tables of ids may begin with one more column, the id that the
# catalogue gives under its own name; see ``flatten.flatten_authors``.
FLAT_COLUMNS: dict[str, list[str]] = {
    "authors": ["id", "orcid", "display_name", "display_name_alternatives", "works_count", "cited_by_count", "last_known_institution", "works_api_url", "updated_date"],
    "authors_ids": ["author_id", "orcid", "scopus", "twitter", "wikipedia", "mag"],
    "authors_counts_by_year": ["author_id", "year", "works_count", "cited_by_count", "oa_works_count"],
    "topics": ["id", "display_name", "subfield_id", "subfield_display_name", "field_id", "field_display_name", "domain_id", "domain_display_name", "description", "keywords", "works_api_url", "wikipedia_id", "works_count", "cited_by_count", "updated_date"],
    "institutions": ["id", "ror", "display_name", "country_code", "type", "homepage_url", "image_url", "image_thumbnail_url", "display_name_acronyms", "display_name_alternatives", "works_count", "cited_by_count", "works_api_url", "updated_date"],
    "institutions_ids": ["institution_id", "ror", "grid", "wikipedia", "wikidata", "mag"],
    "institutions_geo": ["institution_id", "city", "geonames_city_id", "region", "country_code", "country", "latitude", "longitude"],
    "works": ["id", "doi", "title", "display_name", "publication_year", "publication_date", "type", "cited_by_count", "is_retracted", "is_paratext", "language", "cited_by_api_url", "abstract_inverted_index"],
    "works_authorships": ["work_id", "author_position", "author_id", "institution_id", "raw_affiliation_string"],
    "works_biblio": ["work_id", "volume", "issue", "first_page", "last_page"],
    "works_topics": ["work_id", "topic_id", "score"],
    "works_referenced_works": ["work_id", "referenced_work_id"],
}

#: Merge keys of the flat tables; a table not named here merges on ``id``.
MERGE_KEYS: dict[str, list[str]] = {
    "authors": ["id"],
    "topics": ["id"],
    "institutions": ["id"],
    "institutions_ids": ["institution_id"],
    "institutions_geo": ["institution_id"],
    "works": ["id"],
    "works_biblio": ["work_id"],
    "works_authorships": ["work_id", "author_id"],
    "works_topics": ["work_id", "topic_id"],
    "works_referenced_works": ["work_id", "referenced_work_id"],
}

#: Columns that hold record ids and are normalised before a merge.
ID_COLUMNS = (
    "id", "author_id", "institution_id", "work_id", "topic_id", "referenced_work_id",
    "related_work_id", "source_id", "concept_id", "publisher_id", "last_known_institution",
)


def merge_keys(table: str) -> list[str]:
    return MERGE_KEYS.get(table, ["id"])
