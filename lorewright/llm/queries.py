"""Queries of the language-model data problems (2, 3, 5, 7, 8, 9, 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorewright.functions.ids import bare_id
from lorewright.llm import cooccurrence as co
from lorewright.llm import incremental, leakage, names, neighbors, packing, truncation
from lorewright.llm.hot import merge_join
from lorewright.plans.registry import Registry, table
from lorewright.session import materialize

LLM = Registry()


def _bare(c: str) -> str:
    return f"nullif(regexp_extract(coalesce({c},''),'([0-9]+)\\s*$',1),'')"


# --- 2: new batches against all history ------------------------------------------


@LLM.add("p2_found", None)
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each batch that repeat a record of an earlier one, batch after batch."""
    return incremental.repeated_records(table(spark, d, "works"), table(spark, d, "authors"))


@LLM.add("p2_report", None)
def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Repetitions per entity and batch, under the same and under another id."""
    f = p2_found(spark, d)
    same = F.col("id_a") == F.col("id_b")
    return f.groupBy("entity", "batch_no").agg(F.count(F.when(same, 1)).alias("same_id"), F.count(F.when(~same, 1)).alias("other_id"))


# --- 3: items that appear together ---------------------------------------------

_PAIRS = f"""d AS (SELECT DISTINCT {_bare('work_id')} AS w, {_bare('author_id')} AS a FROM works_authorships WHERE {_bare('work_id')} IS NOT NULL AND {_bare('author_id')} IS NOT NULL),
n AS (SELECT a, count(*) AS n FROM d GROUP BY a), t AS (SELECT count(DISTINCT w) AS t FROM d),
p AS (SELECT x.a AS a, y.a AS b, count(*) AS n_ab FROM d x JOIN d y ON x.w=y.w AND x.a<y.a GROUP BY ALL HAVING count(*) >= {{least}})"""


def _memberships(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "works_authorships")
    return a.select(bare_id(F.col("work_id")).alias("w"), bare_id(F.col("author_id")).alias("a"))


@LLM.add(
    "p3_found",
    f"WITH {_PAIRS.format(least=4)} SELECT p.a AS author_a, p.b AS author_b FROM p JOIN n x ON x.a=p.a JOIN n y ON y.a=p.b, t WHERE n_ab*t.t/(x.n*y.n)::DOUBLE >= 10",
)
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Author pairs with at least 4 common works and 10 times as many as chance."""
    found = co.cooccurrence(_memberships(spark, d), "w", "a", min_support=4, min_lift=10.0)
    return found.select(F.col("item_a").alias("author_a"), F.col("item_b").alias("author_b"))


@LLM.add(
    "p3_scores",
    f"WITH {_PAIRS.format(least=2)} SELECT p.a AS author_a, p.b AS author_b, n_ab, round(n_ab*t.t/(x.n*y.n)::DOUBLE, 6) AS lift FROM p JOIN n x ON x.a=p.a JOIN n y ON y.a=p.b, t",
)
def p3_scores(spark: SparkSession, d: str) -> DataFrame:
    """Common works and ratio to chance of all pairs that met at least twice."""
    s = co.cooccurrence(_memberships(spark, d), "w", "a", min_support=2)
    return s.select(F.col("item_a").alias("author_a"), F.col("item_b").alias("author_b"), "n_ab", F.round("lift", 6).alias("lift"))


@LLM.add(
    "p3_pairs",
    f"WITH {_PAIRS.format(least=1)} SELECT p.a AS author_a, p.b AS author_b, n_ab, round(n_ab*t.t/(x.n*y.n)::DOUBLE, 6) AS lift FROM p JOIN n x ON x.a=p.a JOIN n y ON y.a=p.b, t",
)
def p3_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Common works and ratio to chance of every two authors that share a work."""
    s = co.cooccurrence(_memberships(spark, d), "w", "a")
    return s.select(F.col("item_a").alias("author_a"), F.col("item_b").alias("author_b"), "n_ab", F.round("lift", 6).alias("lift"))


# --- 5: most similar vectors ----------------------------------------------------


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "works_vector").select(bare_id(F.col("work_id")).alias("w"), "vec")


@LLM.add("p5_found", None)
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of which one is among the other's 5 most similar and the cosine at least 0.80."""
    n = neighbors.nearest_neighbors(_vectors(spark, d), "w", "vec", k=5, min_cosine=0.8)
    return n.select(F.least("key_a", "key_b").alias("work_a"), F.greatest("key_a", "key_b").alias("work_b")).distinct()


@LLM.add("p5_neighbors", None)
def p5_neighbors(spark: SparkSession, d: str) -> DataFrame:
    """The 5 most similar works of every work, with cosine and rank."""
    return neighbors.exact_neighbors(_vectors(spark, d), "w", "vec", k=5)


# --- 7: variant spellings of names ------------------------------------------------


@LLM.add("p7_found", None)
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of author ids that mean the same person or group."""
    return names.cluster_pairs(names.author_clusters(table(spark, d, "authors")))


@LLM.add("p7_clusters", None)
def p7_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Every linked author id with its class, the size of the class and the number of its own links."""
    links = materialize(names.author_links(table(spark, d, "authors")), "links")
    c = materialize(names.clusters_of(links), "clusters")
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
    return merge_join(merge_join(c, c.groupBy("cluster").agg(F.count("*").alias("members")), "cluster"), ends, "id").select("id", "cluster", "members", "links")


# --- 8: filling containers ----------------------------------------------------------


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents").select("doc_id", "text"), capacity=2048)


@LLM.add("p8_containers", None)
def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Each document's containers of 2,048 tokens."""
    return _packed(spark, d)


@LLM.add("p8_fill", None)
def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are, against the least number that could do."""
    return packing.fill_report(_packed(spark, d))


# --- 9: evaluation texts in training texts --------------------------------------------


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items").select("item_id", "text"))


@LLM.add("p9_found", None)
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a passage of an evaluation item, and the item."""
    return _leaks(spark, d).select("doc_id", "item_id").distinct()


@LLM.add("p9_items", None)
def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Affected documents and the longest piece per item."""
    return leakage.item_report(_leaks(spark, d))


@LLM.add("p9_clean", None)
def p9_clean(spark: SparkSession, d: str) -> DataFrame:
    """The documents that remain when affected ones are removed."""
    docs = table(spark, d, "documents")
    return leakage.remove_leaked(docs.select("doc_id", "lang", "source", "n_chars"), _leaks(spark, d))


# --- 10: truncated texts ------------------------------------------------------------


def _judged(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "doc_kind", "text")
    # judged once: the sources' baselines and the decision both read the verdicts
    return truncation.truncated(materialize(truncation.endings(docs), "endings"))


@LLM.add("p10_found", None)
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that stop inside a word or a sentence."""
    return _judged(spark, d).where("truncated").select("doc_id").distinct()


@LLM.add("p10_sources", None)
def p10_sources(spark: SparkSession, d: str) -> DataFrame:
    """Texts, truncated texts and their share per source."""
    return truncation.source_report(_judged(spark, d))
