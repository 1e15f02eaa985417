"""Queries over the flat tables: one or more per operator of the inventory."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorewright.functions.ids import bare_doi, bare_id, bare_orcid, blank_to_null, normalize_row_ids
from lorewright.functions.text import build_inverted_index, parse_alternatives, reconstruct_abstract, title_and_abstract
from lorewright.operators import collaboration, flatten, mapping, merge, vectors
from lorewright.plans.registry import Registry, table
from lorewright.session import shared_dir
from lorewright.sources.flat import read_flat, typed, write_flat
from lorewright.sources.snapshots import dates_in_range, nearest_date, parse_lines, partition_dates, read_snapshot

R = Registry()

def _norm(c: str) -> str:
    """P1 in SQL: a URL gives its last segment without the leading letter."""
    last = f"list_last(string_split({c},'/'))"
    return f"(CASE WHEN coalesce({c},'')='' THEN '' WHEN starts_with({c},'http') AND length({last})>1 AND regexp_matches(substr({last},1,1),'^\\p{{L}}$') THEN substr({last},2) ELSE {c} END)"


def _bare(c: str) -> str:
    return f"nullif(regexp_extract(coalesce({c},''),'([0-9]+)\\s*$',1),'')"


def _t(c: str) -> str:
    return f"coalesce({c},'')"


# --- ids and scalar expressions ---------------------------------------------


@R.add(
    "normalize_ids",
    f"SELECT {_norm('work_id')} AS work_id, {_norm('author_id')} AS author_id, {_norm('institution_id')} AS institution_id, count(*) AS n FROM works_authorships GROUP BY ALL",
)
def normalize_ids(spark: SparkSession, d: str) -> DataFrame:
    df = normalize_row_ids(table(spark, d, "works_authorships").select("work_id", "author_id", "institution_id"))
    return df.groupBy("work_id", "author_id", "institution_id").agg(F.count("*").alias("n"))


@R.add(
    "bare_keys",
    f"""SELECT {_bare('id')} AS id, CASE WHEN length(regexp_replace(upper({_t('orcid')}),'[^0-9X]','','g'))>=16 THEN right(regexp_replace(upper({_t('orcid')}),'[^0-9X]','','g'),16) END AS orcid,
    nullif(trim({_bare('last_known_institution')}),'') AS institution FROM authors""",
)
def bare_keys(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "authors")
    return a.select(bare_id(F.col("id")).alias("id"), bare_orcid(F.col("orcid")).alias("orcid"), bare_id(F.col("last_known_institution")).alias("institution"))


@R.add(
    "doi_forms",
    r"SELECT nullif(regexp_extract(lower(coalesce(doi,'')),'(10\.[0-9]{3,}/\S+)',1),'') AS doi, count(*) AS n FROM works GROUP BY ALL",
)
def doi_forms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "works").groupBy(bare_doi(F.col("doi")).alias("doi")).agg(F.count("*").alias("n"))


@R.add("typed_works", """SELECT id, try_cast(nullif(trim(publication_year),'') AS INTEGER) AS publication_year, try_cast(nullif(trim(cited_by_count),'') AS BIGINT) AS cited_by_count,
 try_cast(nullif(trim(is_retracted),'') AS BOOLEAN) AS is_retracted FROM works""")
def typed_works(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "works").select("id", "publication_year", "cited_by_count", "is_retracted")
    return typed(w, {"publication_year": "int", "cited_by_count": "bigint", "is_retracted": "boolean"})


@R.add("keyword_lists", """SELECT id, trim(k) AS keyword, count(*) AS n FROM (SELECT id, unnest(string_split_regex(keywords,'[;,|]')) AS k FROM topics WHERE coalesce(keywords,'')<>'') WHERE trim(k)<>'' GROUP BY ALL""")
def keyword_lists(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "topics")
    parts = t.select("id", F.explode(F.split("keywords", "[;,|]")).alias("k"))
    return parts.select("id", F.trim("k").alias("keyword")).where("keyword <> ''").groupBy("id", "keyword").agg(F.count("*").alias("n"))


# --- vertices and edges -------------------------------------------------------


def _vertex_sql(entity: str, props: list[str]) -> str:
    body = ", ".join(f"{p}: {_t(p)}" for p in props)
    return f"SELECT {_t('id')} AS id, to_json({{{body}}})::VARCHAR AS properties FROM {entity}"


for _entity, _props in mapping.VERTEX_PROPERTIES.items():

    def _vertex(spark: SparkSession, d: str, e: str = _entity) -> DataFrame:
        return mapping.vertices(table(spark, d, e), e)

    R.add(f"vertex_{_entity}", _vertex_sql(_entity, list(_props)))(_vertex)

_SCORE = r"regexp_matches(trim(coalesce(score,'')),'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')"


@R.add(
    "edge_work_topic",
    f"""SELECT {_t('work_id')} AS startid, {_t('topic_id')} AS endid, CASE WHEN {_SCORE} THEN try_cast(trim(score) AS DOUBLE) END AS score,
    CASE WHEN NOT {_SCORE} THEN nullif(trim({_t('score')}),'') END AS score_text FROM works_topics""",
)
def edge_work_topic(spark: SparkSession, d: str) -> DataFrame:
    """The edge's JSON read back into columns: number formats differ between engines."""
    e = mapping.topic_edges(table(spark, d, "works_topics"))
    raw = F.get_json_object("properties", "$.score")
    quoted = F.col("properties").startswith('{"score":"')
    return e.select("startid", "endid", F.when(~quoted, raw.cast("double")).alias("score"), F.when(quoted, raw).alias("score_text"))


@R.add(
    "edge_work_author",
    f"""SELECT {_t('work_id')} AS startid, {_t('author_id')} AS endid, CASE WHEN {_t('author_position')}='' THEN '{{}}' ELSE to_json({{author_position: author_position}})::VARCHAR END AS properties FROM works_authorships""",
)
def edge_work_author(spark: SparkSession, d: str) -> DataFrame:
    return mapping.authorship_edges(table(spark, d, "works_authorships"))


@R.add(
    "edge_reference",
    f"SELECT trim({_t('work_id')}) AS startid, trim({_t('referenced_work_id')}) AS endid, '{{}}' AS properties FROM works_referenced_works WHERE trim({_t('work_id')})<>'' AND trim({_t('referenced_work_id')})<>''",
)
def edge_reference(spark: SparkSession, d: str) -> DataFrame:
    return mapping.reference_edges(table(spark, d, "works_referenced_works"))


# --- co-author edges ----------------------------------------------------------

_ROWS = f"""r AS (SELECT DISTINCT {_bare('work_id')} AS w, {_bare('author_id')} AS a, {_bare('institution_id')} AS o FROM works_authorships),
v AS (SELECT w, a, row_number() OVER () AS i FROM r WHERE w IS NOT NULL AND a IS NOT NULL),
p AS (SELECT l.w, least(l.a, x.a) AS a1, greatest(l.a, x.a) AS a2 FROM v l JOIN v x ON l.w=x.w AND l.i<x.i)"""


def _ships(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "works_authorships")
    rows = a.select(*[bare_id(F.col(c)).alias(c) for c in ("work_id", "author_id", "institution_id")])
    return collaboration.one_version(rows.where("work_id IS NOT NULL AND author_id IS NOT NULL"))


def _years(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "works").select(bare_id(F.col("id")).alias("id"), "publication_year", "batch_no", "updated_date")


@R.add("author_collaboration", f"WITH {_ROWS} SELECT a1 AS startid, a2 AS endid, count(*) AS cnt FROM p GROUP BY ALL")
def author_collaboration(spark: SparkSession, d: str) -> DataFrame:
    return collaboration.collaboration_edges(_ships(spark, d), _years(spark, d), with_list=False)


@R.add(
    "author_collaboration_list",
    f"""WITH {_ROWS}, y AS (SELECT w, arg_max(y, k) AS y FROM (SELECT {_bare('id')} AS w, trim(publication_year) AS y, (batch_no, updated_date, trim(publication_year)) AS k FROM works WHERE trim(coalesce(publication_year,''))<>'') WHERE w IS NOT NULL GROUP BY w)
SELECT a1 AS startid, a2 AS endid, count(*) AS cnt, to_json({{cnt: count(*), list: list({{year: coalesce(y,''), work_id: w}} ORDER BY coalesce(y,''), w)}})::VARCHAR AS properties FROM p LEFT JOIN y USING (w) GROUP BY a1, a2""",
)
def author_collaboration_list(spark: SparkSession, d: str) -> DataFrame:
    return collaboration.collaboration_edges(_ships(spark, d), _years(spark, d), order=["batch_no", "updated_date"])


@R.add(
    "collaboration_degree",
    f"""WITH {_ROWS}, e AS (SELECT a1, a2, count(*) AS cnt FROM p WHERE a1<>a2 GROUP BY ALL)
SELECT author_id, count(*) AS partners, CAST(sum(cnt) AS BIGINT) AS joint_works FROM (SELECT a1 AS author_id, cnt FROM e UNION ALL SELECT a2, cnt FROM e) GROUP BY author_id""",
)
def collaboration_degree(spark: SparkSession, d: str) -> DataFrame:
    return collaboration.author_degree(_ships(spark, d))


@R.add(
    "last_wins_year",
    f"SELECT w AS work_id, arg_max(y, k) AS year FROM (SELECT {_bare('id')} AS w, trim(publication_year) AS y, (batch_no, updated_date, trim(publication_year)) AS k FROM works WHERE trim(coalesce(publication_year,''))<>'') WHERE w IS NOT NULL GROUP BY w",
)
def last_wins_year(spark: SparkSession, d: str) -> DataFrame:
    return collaboration.last_year(_years(spark, d), ["batch_no", "updated_date"])


# --- incremental merge --------------------------------------------------------


def _halves(spark: SparkSession, d: str, name: str) -> tuple[DataFrame, DataFrame]:
    df = table(spark, d, name)
    return df.where("batch_no > 0"), normalize_row_ids(df.where("batch_no = 0"))


@R.add(
    "merge_net_new_single",
    f"SELECT {_norm('id')} AS id, title, updated_date, batch_no FROM works WHERE batch_no>0 AND {_norm('id')} NOT IN (SELECT {_norm('id')} FROM works WHERE batch_no=0)",
)
def merge_net_new_single(spark: SparkSession, d: str) -> DataFrame:
    inc, full = _halves(spark, d, "works")
    return merge.net_new(inc, full, ["id"]).select("id", "title", "updated_date", "batch_no")


@R.add(
    "merge_net_new_composite",
    f"""SELECT {_norm('work_id')} AS work_id, {_norm('author_id')} AS author_id, {_norm('institution_id')} AS institution_id, author_position FROM works_authorships x WHERE batch_no>0
    AND NOT EXISTS (SELECT 1 FROM works_authorships f WHERE f.batch_no=0 AND {_norm('f.work_id')}={_norm('x.work_id')} AND {_norm('f.author_id')}={_norm('x.author_id')})""",
)
def merge_net_new_composite(spark: SparkSession, d: str) -> DataFrame:
    inc, full = _halves(spark, d, "works_authorships")
    return merge.net_new(inc, full, ["work_id", "author_id"]).select("work_id", "author_id", "institution_id", "author_position")


@R.add(
    "merge_renamed_full",
    f"""SELECT {_norm('work_id')} AS work_id, {_norm('referenced_work_id')} AS referenced_work_id, batch_no FROM works_referenced_works x WHERE batch_no>0
    AND NOT EXISTS (SELECT 1 FROM works_referenced_works f WHERE f.batch_no=0 AND {_norm('f.work_id')}={_norm('x.work_id')} AND {_norm('f.referenced_work_id')}={_norm('x.referenced_work_id')})""",
)
def merge_renamed_full(spark: SparkSession, d: str) -> DataFrame:
    inc, full = _halves(spark, d, "works_referenced_works")
    other = full.select(F.col("work_id").alias("startid"), F.col("referenced_work_id").alias("endid"))
    keys = ["work_id", "referenced_work_id"]
    return merge.net_new(inc, other, keys, mapping={"work_id": "startid", "referenced_work_id": "endid"}).select(*keys, "batch_no")


@R.add(
    "merge_stats",
    f"""WITH k AS (SELECT DISTINCT {_norm('id')} AS id FROM authors WHERE batch_no=0), i AS (SELECT {_norm('id')} AS id FROM authors WHERE batch_no>0),
s AS (SELECT count(*) AS t, count(*) FILTER (WHERE id IN (SELECT id FROM k)) AS dup FROM i)
SELECT t AS total_rows, t-dup AS new_rows, dup AS duplicate_rows, round(CASE WHEN t>0 THEN 100.0*dup/t ELSE 0 END,4)::DOUBLE AS duplicate_rate FROM s""",
)
def merge_stats(spark: SparkSession, d: str) -> DataFrame:
    inc, full = _halves(spark, d, "authors")
    return merge.merge_stats(inc, full, ["id"])


@R.add("merge_key_stats", f"SELECT count(*) AS rows, count(DISTINCT {_norm('id')}) AS distinct_keys, count(*)-count(DISTINCT {_norm('id')}) AS duplicates FROM works")
def merge_key_stats(spark: SparkSession, d: str) -> DataFrame:
    return merge.key_stats(normalize_row_ids(table(spark, d, "works").select("id")), ["id"])


@R.add("merge_shard_histogram", f"SELECT ('0x'||substr(md5({_norm('id')}),1,8))::BIGINT % 100 AS shard, count(*) AS rows FROM works GROUP BY ALL")
def merge_shard_histogram(spark: SparkSession, d: str) -> DataFrame:
    return merge.shard_histogram(normalize_row_ids(table(spark, d, "works").select("id")), ["id"])


@R.add(
    "dedup_first_wins",
    f"""SELECT id, display_name, updated_date, batch_no FROM (SELECT {_norm('id')} AS id, display_name, updated_date, batch_no,
    row_number() OVER (PARTITION BY {_norm('id')} ORDER BY batch_no, updated_date NULLS FIRST, display_name NULLS FIRST) AS rn FROM topics) WHERE rn=1""",
)
def dedup_first_wins(spark: SparkSession, d: str) -> DataFrame:
    t = normalize_row_ids(table(spark, d, "topics").select("id", "display_name", "updated_date", "batch_no"))
    return merge.first_wins(t, ["id"], ["batch_no", "updated_date"])


@R.add("union_all_tables", "SELECT source, count(*) AS rows FROM (SELECT 'topics' AS source, topic_id AS ref FROM works_topics UNION ALL SELECT 'references', referenced_work_id FROM works_referenced_works) GROUP BY ALL")
def union_all_tables(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "works_topics").select(F.lit("topics").alias("source"), F.col("topic_id").alias("ref"))
    b = table(spark, d, "works_referenced_works").select(F.lit("references").alias("source"), F.col("referenced_work_id").alias("ref"))
    return a.unionByName(b).groupBy("source").agg(F.count("*").alias("rows"))


# --- documents ----------------------------------------------------------------



@R.add(
    "work_documents",
    """WITH w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY batch_no, updated_date, title NULLS FIRST, doi NULLS FIRST) AS rn FROM works) WHERE rn=1),
a AS (SELECT work_id, count(*) AS n, string_agg(concat_ws('/', nullif(author_position,''), nullif(author_id,''), nullif(institution_id,'')), '|' ORDER BY concat_ws('/', nullif(author_position,''), nullif(author_id,''), nullif(institution_id,''))) AS l FROM works_authorships GROUP BY work_id),
t AS (SELECT work_id, count(*) AS n, string_agg(concat_ws('/', nullif(topic_id,''), nullif(score,'')), '|' ORDER BY concat_ws('/', nullif(topic_id,''), nullif(score,''))) AS l FROM works_topics GROUP BY work_id)
SELECT coalesce(w.id,'') AS id, coalesce(w.doi,'') AS doi, nullif(language,'') AS language, coalesce(a.n,0) AS n_authorships, md5(coalesce(a.l,'')) AS authorships, coalesce(t.n,0) AS n_topics, md5(coalesce(t.l,'')) AS topics
FROM w LEFT JOIN a ON a.work_id=w.id LEFT JOIN t ON t.work_id=w.id""",
)
def work_documents(spark: SparkSession, d: str) -> DataFrame:
    """The documents are built whole and their JSON is read back, so key order and number forms do not matter."""
    works = merge.first_wins(table(spark, d, "works").select("id", "doi", "language", "batch_no", "updated_date", "title"), ["id"], ["batch_no", "updated_date", "title", "doi"])
    docs = mapping.work_documents(works, table(spark, d, "works_authorships"), table(spark, d, "works_topics"))
    shape = (
        "language string, authorships array<struct<author_position:string,author:struct<id:string>,institution:struct<id:string>>>, topics array<struct<id:string,score:string>>"
    )
    p = docs.select("id", "doi", F.from_json("doc", shape).alias("p"))

    def digest(c: str, parts: list[str]) -> Column:
        return F.md5(F.array_join(F.array_sort(F.transform(c, lambda x: F.concat_ws("/", *[_path(x, q) for q in parts]))), "|"))

    def _path(x: Column, q: str) -> Column:
        for part in q.split("."):
            x = x[part]
        return x

    return p.select(
        "id",
        "doi",
        "p.language",
        F.size("p.authorships").cast("bigint").alias("n_authorships"),
        digest("p.authorships", ["author_position", "author.id", "institution.id"]).alias("authorships"),
        F.size("p.topics").cast("bigint").alias("n_topics"),
        digest("p.topics", ["id", "score"]).alias("topics"),
    )


@R.add(
    "author_documents",
    r"""WITH s AS (SELECT coalesce(id,'') AS id, nullif(trim(coalesce(orcid,'')),'') AS orcid, trim(coalesce(display_name_alternatives,'')) AS s FROM authors),
l AS (SELECT id, orcid, CASE WHEN s='' THEN []::VARCHAR[] WHEN starts_with(s,'[') AND json_valid(s) THEN CAST(s AS JSON)::VARCHAR[]
 WHEN contains(s,';') THEN list_filter(list_transform(string_split(s,';'), lambda x: trim(x)), lambda x: x<>'')
 WHEN contains(s,',') THEN list_filter(list_transform(string_split(s,','), lambda x: trim(x)), lambda x: x<>'') ELSE [s] END AS l FROM s)
SELECT id, orcid, array_to_string(l,'|') AS alternatives, len(l)::INTEGER AS n FROM l""",
)
def author_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = mapping.author_documents(table(spark, d, "authors"))
    p = docs.select("id", F.from_json("doc", "orcid string, display_name_alternatives array<string>").alias("p"))
    return p.select("id", "p.orcid", F.array_join("p.display_name_alternatives", "|").alias("alternatives"), F.size("p.display_name_alternatives").alias("n"))


@R.add(
    "alternatives_exploded",
    f"""WITH s AS (SELECT {_bare('id')} AS id, trim(coalesce(display_name_alternatives,'')) AS s FROM authors),
l AS (SELECT id, CASE WHEN s='' THEN []::VARCHAR[] WHEN starts_with(s,'[') AND json_valid(s) THEN CAST(s AS JSON)::VARCHAR[]
 WHEN contains(s,';') THEN list_filter(list_transform(string_split(s,';'), lambda x: trim(x)), lambda x: x<>'')
 WHEN contains(s,',') THEN list_filter(list_transform(string_split(s,','), lambda x: trim(x)), lambda x: x<>'') ELSE [s] END AS l FROM s)
SELECT DISTINCT id, unnest(l) AS alternative FROM l""",
)
def alternatives_exploded(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "authors")
    return a.select(bare_id(F.col("id")).alias("id"), F.explode(parse_alternatives(F.col("display_name_alternatives"))).alias("alternative")).distinct()


_VALID = "(json_valid(raw_json) AND json_type(raw_json)='OBJECT' AND trim(coalesce(raw_json->>'$.id',''))<>'')"
_RAW = f"raw AS (SELECT raw_id, raw_json AS j FROM works_raw WHERE CASE WHEN json_valid(raw_json) THEN {_VALID} ELSE false END)"


def _records(spark: SparkSession, d: str) -> DataFrame:
    """Complete lines only: an unterminated line gives no record."""
    raw = table(spark, d, "works_raw").select("raw_id", F.col("raw_json").alias("line")).where(F.try_parse_json("line").isNotNull())
    return parse_lines(raw, "works")


@R.add("flatten_works", f"WITH {_RAW} SELECT j->>'$.id' AS id, j->>'$.doi' AS doi, j->>'$.title' AS title, j->>'$.publication_year' AS publication_year, j->>'$.publication_date' AS publication_date, CASE j->>'$.is_retracted' WHEN 'true' THEN 'True' WHEN 'false' THEN 'False' END AS is_retracted, j->>'$.language' AS language FROM raw")
def flatten_works(spark: SparkSession, d: str) -> DataFrame:
    return flatten.flatten_works(_records(spark, d))["works"].select("id", "doi", "title", "publication_year", "publication_date", "is_retracted", "language")


_SHIPS = "a AS (SELECT j->>'$.id' AS work_id, unnest(CASE json_type(j,'$.authorships') WHEN 'ARRAY' THEN CAST(j->'$.authorships' AS JSON[]) WHEN 'OBJECT' THEN [j->'$.authorships'] ELSE [] END) AS a FROM raw)"


@R.add("flatten_authorships_first", f"WITH {_RAW}, {_SHIPS} SELECT work_id, a->>'$.author_position' AS author_position, a->>'$.author.id' AS author_id, a->>'$.institutions[0].id' AS institution_id, a->>'$.raw_affiliation_string' AS raw_affiliation_string FROM a")
def flatten_authorships_first(spark: SparkSession, d: str) -> DataFrame:
    return flatten.flatten_works(_records(spark, d), "first")["works_authorships"]


@R.add(
    "flatten_authorships_all",
    f"""WITH {_RAW}, {_SHIPS}, b AS (SELECT work_id, a, list_filter(list_transform(CASE json_type(a,'$.institutions') WHEN 'ARRAY' THEN CAST(a->'$.institutions' AS JSON[]) ELSE [] END, lambda i: i->>'$.id'), lambda x: trim(coalesce(x,''))<>'') AS l FROM a WHERE trim(coalesce(a->>'$.author.id',''))<>'')
SELECT work_id, a->>'$.author_position' AS author_position, a->>'$.author.id' AS author_id, unnest(CASE WHEN len(l)=0 THEN [NULL]::VARCHAR[] ELSE l END) AS institution_id, a->>'$.raw_affiliation_string' AS raw_affiliation_string FROM b""",
)
def flatten_authorships_all(spark: SparkSession, d: str) -> DataFrame:
    return flatten.flatten_works(_records(spark, d))["works_authorships"]


@R.add(
    "flatten_topics_links",
    f"""WITH {_RAW}, t AS (SELECT j->>'$.id' AS work_id, unnest(CASE json_type(j,'$.topics') WHEN 'ARRAY' THEN CAST(j->'$.topics' AS JSON[]) WHEN 'OBJECT' THEN [j->'$.topics'] ELSE [] END) AS t FROM raw)
SELECT work_id, t->>'$.id' AS topic_id, t->>'$.score' AS score FROM t WHERE trim(coalesce(t->>'$.id',''))<>''""",
)
def flatten_topics_links(spark: SparkSession, d: str) -> DataFrame:
    return flatten.flatten_works(_records(spark, d))["works_topics"]


@R.add(
    "flatten_references",
    f"""WITH {_RAW}, t AS (SELECT j->>'$.id' AS work_id, unnest(CASE json_type(j,'$.referenced_works') WHEN 'ARRAY' THEN CAST(j->'$.referenced_works' AS VARCHAR[]) ELSE [] END) AS r FROM raw)
SELECT work_id, r AS referenced_work_id FROM t WHERE trim(coalesce(r,''))<>''""",
)
def flatten_references(spark: SparkSession, d: str) -> DataFrame:
    return flatten.flatten_works(_records(spark, d))["works_referenced_works"]


@R.add("flatten_biblio", f"WITH {_RAW} SELECT j->>'$.id' AS work_id, j->>'$.biblio.volume' AS volume, j->>'$.biblio.issue' AS issue, j->>'$.biblio.first_page' AS first_page, j->>'$.biblio.last_page' AS last_page FROM raw WHERE json_type(j,'$.biblio')='OBJECT'")
def flatten_biblio(spark: SparkSession, d: str) -> DataFrame:
    return flatten.flatten_works(_records(spark, d))["works_biblio"]


@R.add(
    "flatten_topic_entity",
    "SELECT id, display_name, subfield_id, subfield_display_name, field_id, domain_id, array_to_string(string_split(keywords,'; '),', ') AS keywords, updated_date FROM topics WHERE trim(coalesce(id,''))<>''",
)
def flatten_topic_entity(spark: SparkSession, d: str) -> DataFrame:
    """Nested topic records are made from the flat table and flattened again."""
    t = table(spark, d, "topics")
    level = {x: F.struct(F.col(f"{x}_id").alias("id"), F.col(f"{x}_display_name").alias("display_name")) for x in ("subfield", "field", "domain")}
    nested = t.select("id", "display_name", *[c.alias(k) for k, c in level.items()], F.split("keywords", "; ").alias("keywords"), F.col("updated_date").alias("updated"))
    records = parse_lines(nested.select(F.to_json(F.struct("*")).alias("line")), "topics")
    return flatten.flatten_topics(records, ", ")["topics"].select("id", "display_name", "subfield_id", "subfield_display_name", "field_id", "domain_id", "keywords", "updated_date")


@R.add("flatten_institution_entity", "SELECT id, ror, display_name, country_code, type, works_count, updated_date FROM institutions WHERE trim(coalesce(id,''))<>''")
def flatten_institution_entity(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "institutions").select("id", "ror", "display_name", "country_code", "type", F.col("works_count").try_cast("bigint").alias("works_count"), "updated_date")
    records = parse_lines(i.select(F.to_json(F.struct("*")).alias("line")), "institutions")
    return flatten.flatten_institutions(records)["institutions"].select("id", "ror", "display_name", "country_code", "type", "works_count", "updated_date")


@R.add(
    "flatten_author_entity",
    "SELECT id, orcid, display_name, last_known_institution, updated_date FROM authors WHERE trim(coalesce(id,''))<>''",
)
def flatten_author_entity(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "authors").select("id", "orcid", "display_name", F.struct(F.col("last_known_institution").alias("id")).alias("last_known_institution"), "updated_date")
    records = parse_lines(a.select(F.to_json(F.struct("*")).alias("line")), "authors")
    return flatten.flatten_authors(records)["authors"].select("id", "orcid", "display_name", "last_known_institution", "updated_date")


@R.add(
    "flatten_counts_by_year",
    "SELECT o_custkey::VARCHAR AS author_id, year(o_orderdate)::VARCHAR AS year, count(*)::VARCHAR AS works_count FROM orders GROUP BY o_custkey, year(o_orderdate)",
)
def flatten_counts_by_year(spark: SparkSession, d: str) -> DataFrame:
    """Orders per customer and year stand in for the yearly counts, nested and exploded again."""
    per = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("id"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("works_count"))
    nested = per.groupBy("id").agg(F.collect_list(F.struct("year", "works_count")).alias("counts_by_year"))
    records = parse_lines(nested.select(F.to_json(F.struct("*")).alias("line")), "authors")
    return flatten.flatten_authors(records)["authors_counts_by_year"].select("author_id", "year", "works_count")


@R.add("json_event_props", "SELECT event_type, CAST(json_extract_string(props,'$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def json_event_props(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_type", F.from_json("props", "k bigint").alias("p"))
    return e.groupBy("event_type", F.col("p.k").alias("k")).agg(F.count("*").alias("n"))


@R.add("malformed_lines", f"SELECT count(*) AS lines, count(*) FILTER (WHERE CASE WHEN json_valid(raw_json) THEN {_VALID} ELSE false END) AS records FROM works_raw")
def malformed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines read, and the records that the reader's own rule for broken lines leaves."""
    raw = table(spark, d, "works_raw").select(F.col("raw_json").alias("line"))
    return raw.agg(F.count("*").alias("lines")).join(parse_lines(raw, "works").agg(F.count("*").alias("records")), F.lit(True))


# --- abstracts ----------------------------------------------------------------


@R.add(
    "abstract_reconstruct",
    f"""WITH {_RAW}, k AS (SELECT raw_id, unnest(json_keys(j->'$.abstract_inverted_index')) AS w, j FROM raw WHERE json_type(j,'$.abstract_inverted_index')='OBJECT'),
e AS (SELECT raw_id, w, unnest(CAST(json_extract(j->'$.abstract_inverted_index', '/'||replace(replace(w,'~','~0'),'/','~1')) AS INTEGER[])) AS p FROM k)
SELECT raw_id, md5(string_agg(w,' ' ORDER BY p)) AS abstract FROM e GROUP BY raw_id""",
)
def abstract_reconstruct(spark: SparkSession, d: str) -> DataFrame:
    r = _records(spark, d).select("raw_id", reconstruct_abstract(F.col("_record.abstract_inverted_index")).alias("abstract"))
    return r.where("abstract IS NOT NULL").select("raw_id", F.md5("abstract").alias("abstract"))


@R.add("abstract_roundtrip", r"SELECT item_id, md5(trim(regexp_replace(text,'\s+',' ','g'))) AS abstract FROM eval_items WHERE trim(coalesce(text,''))<>''")
def abstract_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Inverted index of each text and back: the text with single blanks."""
    e = table(spark, d, "eval_items").select("item_id", F.to_json(build_inverted_index(F.col("text"))).alias("i"))
    return e.select("item_id", F.md5(reconstruct_abstract(F.col("i"))).alias("abstract")).where("abstract IS NOT NULL")


@R.add(
    "title_abstract_text",
    f"""WITH {_RAW}, k AS (SELECT raw_id, unnest(json_keys(j->'$.abstract_inverted_index')) AS w, j FROM raw WHERE json_type(j,'$.abstract_inverted_index')='OBJECT'),
e AS (SELECT raw_id, w, unnest(CAST(json_extract(j->'$.abstract_inverted_index', '/'||replace(replace(w,'~','~0'),'/','~1')) AS INTEGER[])) AS p FROM k),
a AS (SELECT raw_id, string_agg(w,' ' ORDER BY p) AS abstract FROM e GROUP BY raw_id)
SELECT raw_id, md5(trim(coalesce(j->>'$.title','') || ' ' || coalesce(abstract,''))) AS text FROM raw LEFT JOIN a USING (raw_id)""",
)
def title_abstract_text(spark: SparkSession, d: str) -> DataFrame:
    """Title and abstract, the abstract rebuilt from its inverted index."""
    r = _records(spark, d)
    return r.select("raw_id", F.md5(title_and_abstract(F.col("_record.title"), reconstruct_abstract(F.col("_record.abstract_inverted_index")))).alias("text"))


@R.add("work_text", None)
def work_text(spark: SparkSession, d: str) -> DataFrame:
    """Title and rebuilt abstract of every raw record: what a work vector is made from."""
    return mapping.work_texts(_records(spark, d).select("raw_id", "_record.title", "_record.abstract_inverted_index")).select("raw_id", "text")


@R.add(
    "work_documents_in_order",
    f"""WITH {_RAW}, a AS (SELECT raw_id, unnest(range(len(l))) AS pos, unnest(l) AS a FROM (SELECT raw_id, CASE json_type(j,'$.authorships') WHEN 'ARRAY' THEN CAST(j->'$.authorships' AS JSON[]) WHEN 'OBJECT' THEN [j->'$.authorships'] ELSE [] END AS l FROM raw)),
b AS (SELECT raw_id, pos, a->>'$.author.id' AS author, list_filter(list_transform(CASE json_type(a,'$.institutions') WHEN 'ARRAY' THEN CAST(a->'$.institutions' AS JSON[]) ELSE [] END, lambda i: i->>'$.id'), lambda x: trim(coalesce(x,''))<>'') AS l FROM a WHERE trim(coalesce(a->>'$.author.id',''))<>''),
c AS (SELECT raw_id, pos, author, unnest(CASE WHEN len(l)=0 THEN ['']::VARCHAR[] ELSE l END) AS inst, unnest(range(greatest(len(l),1))) AS ipos FROM b)
SELECT raw_id, string_agg(author || ':' || inst, '|' ORDER BY pos, ipos) AS authors, any_value(j->>'$.biblio.volume') AS volume FROM raw JOIN c USING (raw_id) GROUP BY raw_id""",
)
def work_documents_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Documents straight from the nested records: authorships in the order of the source, and the volume."""
    own = _records(spark, d).withColumn("_record", F.col("_record").withField("id", F.col("raw_id").cast("string")))
    flat = flatten.flatten_works(own, ordinals=True)
    docs = mapping.work_documents(flat["works"], flat["works_authorships"], flat["works_topics"], flat["works_biblio"])
    p = docs.select(F.col("id").cast("bigint").alias("raw_id"), F.from_json("doc", "volume string, authorships array<struct<author:struct<id:string>,institution:struct<id:string>>>").alias("p"))
    one = F.transform("p.authorships", lambda x: F.concat(x["author"]["id"], F.lit(":"), F.coalesce(x["institution"]["id"], F.lit(""))))
    return p.where(F.size("p.authorships") > 0).select("raw_id", F.array_join(one, "|").alias("authors"), "p.volume")


# --- dates --------------------------------------------------------------------


@R.add("partition_listing", "SELECT DISTINCT try_cast(updated_date AS DATE) AS date FROM works WHERE try_cast(updated_date AS DATE) IS NOT NULL")
def partition_listing(spark: SparkSession, d: str) -> DataFrame:
    return partition_dates(table(spark, d, "works"), "updated_date")


@R.add("date_range_latest", "SELECT DISTINCT try_cast(updated_date AS DATE) AS date FROM works WHERE try_cast(updated_date AS DATE) >= DATE '2024-02-01'")
def date_range_latest(spark: SparkSession, d: str) -> DataFrame:
    return dates_in_range(table(spark, d, "works"), "updated_date", "2024-02-01", "latest")


@R.add("nearest_date", "SELECT try_cast(updated_date AS DATE) AS date FROM works WHERE try_cast(updated_date AS DATE) IS NOT NULL ORDER BY abs(date_diff('day', DATE '2021-12-25', try_cast(updated_date AS DATE))), 1 DESC LIMIT 1")
def nearest(spark: SparkSession, d: str) -> DataFrame:
    return nearest_date(table(spark, d, "works"), "updated_date", "2021-12-25")


# --- vectors ------------------------------------------------------------------


@R.add("vector_normalize", "SELECT vec_id, round(list_sum(list_transform(v, lambda x: x*x)),6) AS norm2, round(v[1],6) AS first FROM (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x/sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y*y)))) AS v FROM embeddings)")
def vector_normalize(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select("vec_id", vectors.l2_normalize(F.col("embedding")).alias("v"))
    return v.select("vec_id", F.round(vectors.dot(F.col("v"), F.col("v")), 6).alias("norm2"), F.round(F.get("v", 0), 6).alias("first"))


@R.add(
    "vector_cosine_topk",
    """WITH s AS (SELECT q.vec_id AS query_id, c.vec_id AS match_id, round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]),6) AS cosine FROM embeddings q JOIN embeddings c ON q.vec_id<>c.vec_id WHERE q.vec_id%100=0)
SELECT query_id, match_id, cosine, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, match_id) AS rank FROM s) WHERE rank<=10""",
)
def vector_cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return vectors.cosine_topk(e.where("vec_id % 100 = 0"), e, 10)


@R.add("text_vector", None)
def text_vector(spark: SparkSession, d: str) -> DataFrame:
    works = table(spark, d, "works")
    w = merge.first_wins(works.select("id", "doi", "title", "batch_no", *[c for c in ("abstract_inverted_index",) if c in works.columns]), ["id"], ["batch_no"])
    texts = mapping.work_texts(w).select(F.col("id").alias("work_id"), "doi", "text")
    return vectors.encode_text(texts, F.col("text")).drop("text")


@R.add("topic_vector", None)
def topic_vector(spark: SparkSession, d: str) -> DataFrame:
    t = merge.first_wins(table(spark, d, "topics").select("id", "keywords", "batch_no"), ["id"], ["batch_no"])
    return vectors.encode_text(t.select("id", "keywords"), F.col("keywords")).drop("keywords")


@R.add(
    "vector_similarity_matrix",
    "SELECT q.vec_id AS a, c.vec_id AS b, round(20*list_dot_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]),4) AS score FROM embeddings q, embeddings c WHERE q.vec_id%100=0",
)
def vector_similarity_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Scaled dot products of a stated query set with all rows."""
    e = table(spark, d, "embeddings")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("a"), F.col("embedding").alias("x"))
    c = e.select(F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    return c.join(q, F.lit(True)).select("a", "b", F.round(20 * vectors.dot(F.col("x"), F.col("y")), 4).alias("score"))


@R.add(
    "vector_mean_pool",
    "SELECT vec_id, round((embedding[1]::DOUBLE+embedding[17]::DOUBLE+embedding[33]::DOUBLE)/3,6) AS first, round((embedding[16]::DOUBLE+embedding[32]::DOUBLE+embedding[48]::DOUBLE)/3,6) AS last FROM embeddings",
)
def vector_mean_pool(spark: SparkSession, d: str) -> DataFrame:
    """Each vector's four quarters stand in for tokens, of which the last is masked."""
    e = table(spark, d, "embeddings")
    tokens = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.transform(F.slice("embedding", i * 16 + 1, F.lit(16)), lambda x: x.cast("double")))
    pooled = vectors.mean_pool(tokens, F.array(F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(0.0)), 16)
    return e.select("vec_id", pooled.alias("p")).select("vec_id", F.round(F.get("p", 0), 6).alias("first"), F.round(F.get("p", 15), 6).alias("last"))


# --- resume -------------------------------------------------------------------


@R.add("pending_files", "SELECT DISTINCT file_name FROM works_raw WHERE updated_date >= '2024-03-01' AND file_name NOT IN (SELECT file_name FROM works_raw WHERE updated_date < '2024-03-01' AND file_name IS NOT NULL)")
def pending(spark: SparkSession, d: str) -> DataFrame:
    from lorewright.sources.snapshots import pending_files

    raw = table(spark, d, "works_raw").select("updated_date", "file_name")
    return pending_files(raw.where("updated_date >= '2024-03-01'").select("file_name").distinct(), raw.where("updated_date < '2024-03-01'"))


@R.add("quality_report", "SELECT count(*) AS rows, count(*) FILTER (WHERE coalesce(trim(author_id),'')='') AS no_author, count(*) FILTER (WHERE coalesce(trim(institution_id),'')='') AS no_institution, count(*) FILTER (WHERE coalesce(trim(author_position),'')='') AS no_position FROM works_authorships")
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "works_authorships")
    blank = lambda c: F.count(F.when(blank_to_null(F.col(c)).isNull(), 1))
    return a.agg(F.count("*").alias("rows"), blank("author_id").alias("no_author"), blank("institution_id").alias("no_institution"), blank("author_position").alias("no_position"))


@R.add("csv_round_trip", "SELECT coalesce(id,'') AS id, coalesce(title,'') AS title, coalesce(doi,'') AS doi FROM works")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Written as a compressed flat table and read again: quotes, line breaks and padding survive."""
    path = f"{shared_dir(spark)}/lorewright-csv-{uuid.uuid4().hex}"
    write_flat(table(spark, d, "works"), path, ["id", "title", "doi"])
    return read_flat(spark, path)


@R.add("snapshot_round_trip", "SELECT coalesce(id,'') AS id, display_name, batch_no::VARCHAR AS batch FROM topics WHERE trim(coalesce(id,''))<>''")
def snapshot_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Topics written as dated JSON lines and read as a snapshot of all dates."""
    root = f"{shared_dir(spark)}/lorewright-lines-{uuid.uuid4().hex}"
    t = table(spark, d, "topics")
    lines = t.select(F.coalesce(F.col("updated_date").try_cast("date"), F.lit("1970-01-01").cast("date")).alias("updated_date"), F.to_json(F.struct("id", "display_name", F.col("batch_no").cast("string").alias("description"))).alias("value"))
    lines.write.partitionBy("updated_date").option("compression", "gzip").text(f"{root}/topics")
    return read_snapshot(spark, root, "topics").select("_record.id", "_record.display_name", F.col("_record.description").alias("batch"))
