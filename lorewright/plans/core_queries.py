"""Queries of the general training-data problems (1, 4 and 6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorewright.functions.ids import bare_id
from lorewright.operators import merkle, orphans, skew
from lorewright.plans.registry import Registry, table

CORE = Registry()


def _bare(c: str) -> str:
    return f"nullif(regexp_extract(coalesce({c},''),'([0-9]+)\\s*$',1),'')"


def _readable(c: str) -> str:
    return f"nullif(coalesce({_bare(c)}, trim({c})),'')"


# --- 1: nested records --------------------------------------------------------


def _store(spark: SparkSession, d: str) -> merkle.ObjectStore:
    return merkle.build_store(table(spark, d, "works_raw"), "raw_id", "raw_json")


def _list(path: str, j: str = "j") -> str:
    return f"CASE json_type({j},'$.{path}') WHEN 'ARRAY' THEN CAST({j}->'$.{path}' AS JSON[]) WHEN 'OBJECT' THEN [{j}->'$.{path}'] ELSE [] END"


@CORE.add(
    "p1_found",
    f"""WITH raw AS MATERIALIZED (SELECT raw_id, raw_json AS j, {_readable("(raw_json->>'$.id')")} AS wid FROM works_raw WHERE CASE WHEN json_valid(raw_json) THEN json_type(raw_json)='OBJECT' ELSE false END),
r AS (SELECT * FROM raw WHERE wid IS NOT NULL),
a AS (SELECT raw_id, unnest(range(len(l))) AS pos, unnest(l) AS a FROM (SELECT raw_id, {_list('authorships')} AS l FROM r)),
b AS (SELECT raw_id, pos, {_readable("(a->>'$.author.id')")} AS author, list_filter(list_transform({_list('institutions', 'a')}, lambda i: i->>'$.id'), lambda x: trim(coalesce(x,''))<>'') AS l FROM a),
c AS (SELECT raw_id, pos, author, unnest(CASE WHEN len(l)=0 THEN ['']::VARCHAR[] ELSE l END) AS inst FROM b WHERE author IS NOT NULL),
t AS (SELECT raw_id, unnest(range(len(l))) AS pos, unnest(l) AS t FROM (SELECT raw_id, {_list('topics')} AS l FROM r)),
w AS (SELECT raw_id, unnest(range(len(l))) AS pos, unnest(l)->>'$' AS w FROM (SELECT raw_id, {_list('referenced_works')} AS l FROM r))
SELECT DISTINCT * FROM (SELECT raw_id, 'works' AS src_table, 0 AS item_pos, wid AS child_id, '' AS extra_id FROM r
UNION ALL SELECT raw_id, 'works_authorships', pos::INTEGER, author, coalesce({_readable('inst')},'') FROM c
UNION ALL SELECT raw_id, 'works_topics', pos::INTEGER, {_readable("(t->>'$.id')")}, '' FROM t WHERE {_readable("(t->>'$.id')")} IS NOT NULL
UNION ALL SELECT raw_id, 'works_referenced_works', pos::INTEGER, {_readable('w')}, '' FROM w WHERE {_readable('w')} IS NOT NULL)""",
)
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Flat rows of every raw record, rebuilt from the object store."""
    rows = merkle.flat_rows(_store(spark, d))
    ids = F.array_distinct(F.transform("institutions", lambda i: i["id"]))
    extra = F.explode(F.when(F.size(ids) > 0, ids).otherwise(F.array(F.lit(""))))
    return rows.select(F.col("record").alias("raw_id"), "src_table", "item_pos", "child_id", extra.alias("extra_id"))


@CORE.add("p1_object_counts", None)
def p1_object_counts(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences against stored objects per parent field: what storing once saves."""
    uses = merkle.object_uses(table(spark, d, "works_raw"), "raw_json")
    return uses.groupBy("field").agg(F.sum("n").alias("occurrences"), F.count("child").alias("objects"))


_WORK_FIELDS = ", ".join(f"raw_json->>'$.{c}' AS {c}" for c in ("doi", "title", "publication_year", "publication_date", "type", "language"))


@CORE.add("p1_works", f"SELECT raw_id, {_readable("(raw_json->>'$.id')")} AS work_id, {_WORK_FIELDS} FROM works_raw WHERE CASE WHEN json_valid(raw_json) THEN json_type(raw_json)='OBJECT' AND {_readable("(raw_json->>'$.id')")} IS NOT NULL ELSE false END")
def p1_works(spark: SparkSession, d: str) -> DataFrame:
    return merkle.flat_works(_store(spark, d))["works"].drop("item_pos").withColumnRenamed("record", "raw_id")


@CORE.add("p1_rejected", "SELECT raw_id, CASE WHEN trim(coalesce(raw_json,''))='' THEN 'blank' WHEN NOT json_valid(raw_json) THEN 'broken' ELSE 'no object' END AS problem FROM works_raw WHERE CASE WHEN json_valid(raw_json) THEN json_type(raw_json)<>'OBJECT' ELSE true END")
def p1_rejected(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are not one complete JSON object, and why."""
    return _store(spark, d).records.where("root IS NULL").select(F.col("record").alias("raw_id"), "problem")


# --- 4: orphan references -----------------------------------------------------

#: child table, reference column, parent table
REFERENCES = (
    ("works_referenced_works", "referenced_work_id", "works"),
    ("works_authorships", "author_id", "authors"),
    ("works_topics", "topic_id", "topics"),
)


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    deleted = table(spark, d, "deleted_keys")
    parts = []
    for child, column, parent in REFERENCES:
        history = orphans.parent_history(table(spark, d, parent), deleted, parent)
        found = orphans.orphan_references(table(spark, d, child), column, history)
        parts.append(found.withColumn("src_table", F.lit(child)))
    return reduce(DataFrame.unionByName, parts)


def _orphan_sql(child: str, column: str, parent: str) -> str:
    return f"""SELECT '{child}' AS src_table, CASE WHEN length(c.updated_date)>=7 THEN substr(c.updated_date,1,7) END AS upd_month, {_readable('c.work_id')} AS work_id, {_readable(f'c.{column}')} AS ref_id, c.batch_no,
 p.first_batch, k.deleted_batch, 1 AS n FROM {child} c LEFT JOIN (SELECT {_bare('id')} AS id, min(batch_no) AS first_batch FROM {parent} GROUP BY 1) p ON p.id={_readable(f'c.{column}')}
 LEFT JOIN (SELECT {_bare('id')} AS id, min(batch_no) AS deleted_batch FROM deleted_keys WHERE entity='{parent}' GROUP BY 1) k ON k.id={_readable(f'c.{column}')}
 WHERE {_readable(f'c.{column}')} IS NOT NULL AND (p.first_batch IS NULL OR p.first_batch>c.batch_no OR coalesce(k.deleted_batch<=c.batch_no,false))"""


_ORPHANS = " UNION ALL ".join(_orphan_sql(*r) for r in REFERENCES)


@CORE.add("p4_found", f"SELECT DISTINCT src_table, upd_month, work_id, ref_id FROM ({_ORPHANS})")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """References whose parent is missing, later or deleted at their batch."""
    return _orphans(spark, d).select("src_table", "upd_month", "work_id", "ref_id").distinct()


@CORE.add(
    "p4_report",
    f"""SELECT src_table, upd_month, count(*) AS orphan_rows, count(DISTINCT ref_id) AS orphan_keys,
 count(*) FILTER (WHERE first_batch IS NULL) AS missing, count(*) FILTER (WHERE first_batch>batch_no AND NOT coalesce(deleted_batch<=batch_no,false)) AS late,
 count(*) FILTER (WHERE first_batch IS NOT NULL AND coalesce(deleted_batch<=batch_no,false)) AS deleted FROM ({_ORPHANS}) GROUP BY ALL""",
)
def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_orphans(spark, d))


# --- 6: heavy keys ------------------------------------------------------------

#: table, key column, value column
HEAVY = (("works_authorships", "work_id", "author_id"), ("works_referenced_works", "referenced_work_id", "work_id"))


def _frequencies(spark: SparkSession, d: str, name: str, key: str, value: str) -> DataFrame:
    rows = table(spark, d, name).select(bare_id(F.col(key)).alias("k"), bare_id(F.col(value)).alias("v"))
    return skew.value_frequencies(rows, "k", "v")


def _heavy_sql(name: str, key: str) -> str:
    return f"SELECT '{name}' AS src_table, {_bare(key)} AS key_id, count(*) AS rows FROM {name} WHERE {_bare(key)} IS NOT NULL GROUP BY 2 HAVING count(*) >= 0.01*(SELECT count(*) FROM {name})"


@CORE.add("p6_found", "SELECT src_table, key_id FROM (" + " UNION ALL ".join(_heavy_sql(n, k) for n, k, _ in HEAVY) + ")")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Keys holding at least 1 percent of their table's rows."""
    parts = [skew.heavy_keys(_frequencies(spark, d, n, k, v), 0.01).select(F.lit(n).alias("src_table"), F.col("key").alias("key_id")) for n, k, v in HEAVY]
    return reduce(DataFrame.unionByName, parts)


@CORE.add(
    "p6_key_statistics",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS src_table, key, CAST(sum(n) AS BIGINT) AS rows, count(value) AS distinct_values, arg_min(value, (-n, value)) FILTER (WHERE value IS NOT NULL) AS mode, coalesce(max(n) FILTER (WHERE value IS NOT NULL),0) AS mode_rows
FROM (SELECT {_bare(k)} AS key, {_bare(v)} AS value, count(*) AS n FROM {n} GROUP BY ALL) GROUP BY key"""
        for n, k, v in HEAVY
    ),
)
def p6_key_statistics(spark: SparkSession, d: str) -> DataFrame:
    parts = [skew.key_statistics(_frequencies(spark, d, n, k, v)).select(F.lit(n).alias("src_table"), "*") for n, k, v in HEAVY]
    return reduce(DataFrame.unionByName, parts)


@CORE.add(
    "p6_percentiles",
    """SELECT key, probability, value FROM (SELECT key, unnest([0.25::DOUBLE,0.5,0.9]) AS probability, unnest(quantile_disc(value,[0.25,0.5,0.9])) AS value
 FROM (SELECT nullif(regexp_extract(coalesce(referenced_work_id,''),'([0-9]+)\\s*$',1),'') AS key, try_cast(nullif(regexp_extract(coalesce(work_id,''),'([0-9]+)\\s*$',1),'') AS BIGINT) AS value FROM works_referenced_works) WHERE key IS NOT NULL AND value IS NOT NULL GROUP BY key)""",
)
def p6_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Quartile, median and ninth decile of the citing ids of each referenced work."""
    rows = table(spark, d, "works_referenced_works").select(bare_id(F.col("referenced_work_id")).alias("k"), bare_id(F.col("work_id")).cast("bigint").alias("v")).where("k IS NOT NULL")
    return skew.weighted_percentiles(skew.value_frequencies(rows, "k", "v"), [0.25, 0.5, 0.9])


@CORE.add("p6_lists", None)
def p6_lists(spark: SparkSession, d: str) -> DataFrame:
    """The complete lists of the authors of every work and of the works that cite every work, in chunks of about a thousand."""
    parts = [skew.chunked_lists(_frequencies(spark, d, n, k, v)).select(F.lit(n).alias("src_table"), "*") for n, k, v in HEAVY]
    return reduce(DataFrame.unionByName, parts)
