"""New batches against everything accepted: an incremental inverted index.

Records with equal content form one class, stored once.  A class is posted
under tokens from which its possible matches follow:

* titles of n words match position by position with at most c(n) changed
  words, so of the numbered words of one at least n - c(n) are words of the
  other, and the ``c(n) + 1`` rarest of each must meet;
* titles whose words were split or joined agree in letters up to one slip, so
  they share the first or the last half of their letters;
* a title of one word, and the family name or group word of an author, is
  posted under what is left when its possible slips are deleted, or, from 23
  letters on, under five segments of which two slips leave one whole;
* authors are then posted under context (institution or ORCID) and word.

A new batch looks its tokens up, drops pairs whose lengths, years or DOIs rule
them out, verifies the overlap and then the reading rules on the stored
contents, and appends its own postings.  Every table of the index is cut into
buckets by a hash of its key and written per batch; a batch reads only the
buckets its own keys fall into.  History is never regrouped: classes and ids
of authors carry a label, labels that turn out to be one are recorded as
merged, and each label keeps its earliest record.

The index lives under one folder and can be opened again from there.  A batch
counts when its state file stands; what a lost run left of it is overwritten.

The token order and the common given names are fixed by the first batch;
tokens that are new later count as rarest, so the order never changes and the
prefix rule stays exact.

Works match by equal DOI, or, where one lacks a DOI and the years differ by at
most 1, by titles that say the same words.  Authors match by names that read
as one within a shared institution or ORCID, and transitively.

Defined cases: rows without a readable id or batch are skipped; a missing
title, year, name or context matches nothing; repeated rows are one class; a
repetition of several records names the earliest (batch, date, id); an empty
batch changes nothing; an empty table gives an empty result; a batch that was
accepted before is refused.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorewright.functions.ids import bare_doi, bare_id, bare_orcid
from lorewright.llm import names as nm
from lorewright.llm.components import connected_components
from lorewright.llm.titles import most_changed, same_title, title_words
from lorewright.session import empty, materialize, shared_dir, spread, tidy, together

_HEAD = "struct<batch_no:int,updated:string,id:string>"
_PARTS = "array<struct<kind:string,n:int,most:int,side:int,tokens:array<string>>>"
_FEATURES = f"entity string, id string, batch_no int, updated string, doi string, year int, words array<string>, names array<string>, contexts array<string>, facets array<string>, parts {_PARTS}"
BOTH, POST, PROBE = 0, 1, 2

#: Tables of the index and the column whose hash gives the bucket.
TABLES = {
    "order": ("token string, df bigint", "token"),
    "postings": ("token string, slot int, kind string, n int, ref string, has_doi boolean", "token"),
    "facets": ("token bigint, facet string", "token"),
    "registry": (f"entity string, cls string, head {_HEAD}, doi string, year int, words array<string>, names array<string>, contexts array<string>", "cls"),
    "nodes": ("node string, label string", "node"),
    "merges": ("label string, into string", "label"),
    "best": (f"label string, best {_HEAD}", "label"),
}


def variants(word: str, slips: int) -> set[str]:
    """What is left of a word when up to ``slips`` letters are deleted."""
    return {"".join(c for i, c in enumerate(word) if i not in gone) for k in range(min(slips, len(word)) + 1) for gone in combinations(range(len(word)), k)}


def _segments(length: int) -> list[tuple[int, int]]:
    cuts = [length * i // 5 for i in range(6)]
    return list(zip(cuts, cuts[1:]))


def slip_tokens(word: str, slips: int) -> tuple[set[str], set[str]]:
    """Tokens to post and tokens to look up: words within ``slips`` (at most 2) always share one.

    Deletion variants up to 26 letters, segments from 23 on: words whose
    lengths differ by at most two always have one of the two in common.
    """
    post: set[str] = set()
    probe: set[str] = set()
    if len(word) <= 26:
        post = probe = variants(word, slips)
    if len(word) >= 23:
        post = post | {f"{len(word)}:{i}:{word[a:b]}" for i, (a, b) in enumerate(_segments(len(word)))}
        near = {f"{n}:{i}:{word[a + s : b + s]}" for n in range(len(word) - 2, len(word) + 3) for i, (a, b) in enumerate(_segments(n)) for s in range(-2, 3) if a + s >= 0}
        probe = probe | near
    return post, probe


def facet_tokens(facet: str) -> tuple[set[str], set[str]]:
    slips = 2 if len(facet) >= 8 else 1 if len(facet) >= 4 else 0
    both = [slip_tokens(form, slips) for form in {facet, facet.replace("rn", "m")}]
    return set().union(*(p for p, _ in both)), set().union(*(q for _, q in both))


def _numbered(words: list[str]) -> list[str]:
    """Words with the number of their repetition, so that sets of them count like multisets."""
    seen: Counter[str] = Counter()
    out = []
    for w in words:
        seen[w] += 1
        out.append(w if seen[w] == 1 else f"{w}#{seen[w]}")
    return out


def _plain(words: list[str]) -> list[str]:
    return [w.partition("#")[0] for w in words]


def title_parts(words: list[str]) -> list[dict]:
    """The token sets under which a title is posted and looked up."""
    n = len(words)
    if not n:
        return []

    def part(kind: str, side: int, tokens: set[str], most: int) -> dict:
        return {"kind": kind, "n": n, "most": most, "side": side, "tokens": sorted(tokens)}

    letters = "".join(words)
    half = lambda of: max(of // 2 - 1, 0)
    ends = lambda of: {f"h{of}:{letters[: half(of)]}", f"t{of}:{letters[len(letters) - half(of) :]}"}
    size = len(letters)
    parts = [part("h", POST, ends(size), 0), part("h", PROBE, ends(size - 1) | ends(size) | ends(size + 1), 0)]
    if n == 1:
        post, probe = slip_tokens(words[0], 2 if size >= 8 else 1)
        return [*parts, part("v", POST, {f"v{t}" for t in post}, 0), part("v", PROBE, {f"v{t}" for t in probe}, 0)]
    return [*parts, part("w", BOTH, set(_numbered(words)), most_changed(n) + 1)]


def author_facets(names: list[nm.Name]) -> set[str]:
    """The words of which two names of one author must nearly share one: family names, group words, the acronym."""
    out: set[str] = set()
    for kind, given, family in names:
        out.update(family)
        if kind == "g":
            out.update(w for w in given if w not in nm.GROUP_WORDS)
    return {p for p in out if p}


def work_features(works: DataFrame) -> DataFrame:
    """Content and tokens of works rows."""
    r = works.select(
        bare_id(F.col("id")).alias("id"),
        F.col("batch_no").cast("int").alias("batch_no"),
        F.coalesce("updated_date", F.lit("")).alias("updated"),
        bare_doi(F.col("doi")).alias("doi"),
        F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.nullif(F.trim("display_name"), F.lit(""))).alias("title"),
        F.trim(F.coalesce("publication_year", F.substring("publication_date", 1, 4))).try_cast("int").alias("year"),
    ).where("id IS NOT NULL AND batch_no IS NOT NULL")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ws = [title_words(t) for t in b["title"]]
            none: list[list] = [[] for _ in ws]
            yield pd.DataFrame(
                {
                    "entity": "works", "id": b["id"], "batch_no": b["batch_no"], "updated": b["updated"], "doi": b["doi"], "year": b["year"].astype("Int32"),
                    "words": [_numbered(w) for w in ws], "names": none, "contexts": none, "facets": none, "parts": [[] if pd.isna(y) else title_parts(w) for w, y in zip(ws, b["year"])],
                }
            )

    return r.distinct().mapInPandas(parse, _FEATURES)


def author_features(authors: DataFrame) -> DataFrame:
    """Content and facets of authors rows; without a context there is nothing to look up."""
    r = authors.select(
        bare_id(F.col("id")).alias("id"),
        F.col("batch_no").cast("int").alias("batch_no"),
        F.coalesce("updated_date", F.lit("")).alias("updated"),
        F.col("display_name").alias("d"),
        F.col("display_name_alternatives").alias("a"),
        F.array_compact(F.array(F.concat(F.lit("i"), bare_id(F.col("last_known_institution"))), F.concat(F.lit("o"), bare_orcid(F.col("orcid"))))).alias("contexts"),
    ).where("id IS NOT NULL AND batch_no IS NOT NULL")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [nm.names_of([d], [a]) for d, a in zip(b["d"], b["a"])]
            none: list[list] = [[] for _ in found]
            yield pd.DataFrame(
                {
                    "entity": "authors", "id": b["id"], "batch_no": b["batch_no"], "updated": b["updated"], "doi": None, "year": pd.array([0] * len(b), dtype="Int32"),
                    "words": none, "names": [[nm.encode(x) for x in n] for n in found], "contexts": b["contexts"], "facets": [sorted(author_facets(n)) if len(c) else [] for n, c in zip(found, b["contexts"])], "parts": none,
                }
            )

    return r.distinct().mapInPandas(parse, _FEATURES)


def with_class(features: DataFrame) -> DataFrame:
    """Append ``cls``, the 128-bit identity of a record's content, written without ambiguity."""
    content = F.to_json(F.struct("entity", "doi", "year", "words", "names", F.array_sort("contexts").alias("contexts")))
    return features.withColumn("cls", F.concat(F.lit("c"), F.md5(content)))


def _verify(batches: Iterator[pd.DataFrame], established: frozenset[str]) -> Iterator[pd.DataFrame]:
    for b in batches:
        keep = []
        for entity, wa, wb, da, db, ya, yb, na, nb, ca, cb in zip(*[b[c] for c in ("entity", "words_a", "words_b", "doi_a", "doi_b", "year_a", "year_b", "names_a", "names_b", "contexts_a", "contexts_b")]):
            if entity == "works":
                has_a, has_b = isinstance(da, str), isinstance(db, str)
                if has_a and has_b:
                    keep.append(da == db)
                else:
                    keep.append(not pd.isna(ya) and not pd.isna(yb) and abs(ya - yb) <= 1 and same_title(_plain(wa), _plain(wb)))
            else:
                keep.append(bool(set(ca) & set(cb)) and any(nm.same_name(nm.decode(x), nm.decode(y), established) for x in na for y in nb))
        yield b.loc[keep, ["entity", "a", "b", "head_b"]]


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b[[nm.close(f, g, 4, 8) for f, g in zip(b["facet"], b["g"])]]


def _post_facets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(f, pd.isna(s), f"f{t}", t in post, t in probe) for f, s in zip(b["facet"], b["stood"]) for post, probe in [facet_tokens(f)] for t in sorted(post | probe)]
        yield pd.DataFrame(rows, columns=["facet", "fresh", "token", "post", "probe"])


class IncrementalIndex:
    """The index of all accepted records, kept under one folder.

    ``IncrementalIndex(spark, path)`` opens what stands there or begins anew;
    without a path the folder lies in the shared scratch folder and ``close``
    removes it.  ``buckets`` is fixed when the index begins: choose it so that
    a bucket of the postings is some hundred MB.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 8) -> None:
        self.spark = spark
        self.owned = path is None
        self.path = path or f"{shared_dir(spark)}/lorewright-index-{uuid.uuid4().hex}"
        self.buckets = buckets
        self.batches: list[int] = []
        self.established: frozenset[str] = frozenset()
        self.touched: dict[str, list[int]] = {}
        self.size = 0
        folder = self._hadoop(f"{self.path}/state")
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            states = [json.loads(r[0]) for r in spark.read.option("wholetext", "true").text(f"{self.path}/state").collect()]
            self.batches = sorted(s["batch"] for s in states)
            self.buckets = states[0]["buckets"]
            self.established = frozenset(next(s["established"] for s in states if s["established"] is not None))

    def _hadoop(self, path: str) -> object:
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _finish(self, batch_no: int) -> None:
        """The state file makes the batch count."""
        first = not self.batches
        path = self._hadoop(f"{self.path}/state/batch-{batch_no}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(json.dumps({"batch": batch_no, "buckets": self.buckets, "established": sorted(self.established) if first else None}).encode()))
        out.close()
        self.batches.append(batch_no)

    def close(self) -> None:
        """Remove the folder if it is this object's own; results stay, they were written apart."""
        if self.owned:
            folder = self._hadoop(self.path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def __enter__(self) -> IncrementalIndex:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _append(self, df: DataFrame, name: str, batch_no: int) -> None:
        schema, key = TABLES[name]
        placed = df.select(*[c.split()[0] for c in schema.replace(_HEAD, "x").split(", ")]).withColumn("bucket", self._bucket(F.col(key)))
        if name not in ("merges", "best"):  # these are few rows
            placed = placed.repartition(self.buckets, "bucket")
        placed.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self.path}/{name}/added={batch_no}")

    def _read(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows of a table in the buckets that the one column of ``keys`` falls into."""
        schema, key = TABLES[name]
        if not self.batches:
            return empty(self.spark, schema)
        df = self.spark.read.schema(f"{schema}, added int, bucket int").parquet(f"{self.path}/{name}").where(F.col("added").isin(self.batches))
        if self.size < 20 * self.buckets:  # more keys than that fall into every bucket: nothing to find out
            self.touched[name] = sorted(r[0] for r in keys.select(self._bucket(F.col(keys.columns[0])).alias("b")).where("b IS NOT NULL").distinct().collect())
            df = df.where(F.col("bucket").isin(self.touched[name]))
        return df.drop("added", "bucket")

    def _probes(self, classes: DataFrame, batch_no: int) -> DataFrame:
        """``cls, kind, side, n, has_doi, slot, token`` of the works of a batch."""
        works = classes.where("entity = 'works'").withColumn("has_doi", F.col("doi").isNotNull())
        parts = works.select("cls", "has_doi", F.col("year").alias("slot"), F.inline("parts"))
        words = parts.where("kind = 'w'").select("cls", "has_doi", "slot", "kind", "side", "n", "most", F.explode("tokens").alias("token"))
        if not self.batches:
            self._append(words.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "order", batch_no)
            order = self.spark.read.schema("token string, df bigint").parquet(f"{self.path}/order")
        else:
            order = self._read("order", words.select("token"))
        by = ["cls", "has_doi", "slot", "kind", "side", "n", "most"]
        ranked = words.join(order, "token", "left").groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token"))).alias("t"))
        columns = ["cls", "kind", "side", "n", "has_doi", "slot"]
        rare = ranked.select(*columns, F.explode(F.slice("t", F.lit(1), F.col("most"))).alias("x")).select(*columns, F.concat(F.lit("w"), F.col("n").cast("string"), F.lit(":"), F.col("x.token")).alias("token"))
        rest = parts.where("kind <> 'w'").select(*columns, F.explode("tokens").alias("token"))
        dois = works.where("has_doi").select("cls", F.lit("d").alias("kind"), F.lit(BOTH).alias("side"), F.lit(0).alias("n"), "has_doi", F.lit(0).alias("slot"), F.concat(F.lit("d"), "doi").alias("token"))
        return materialize(rare.unionByName(rest).unionByName(dois), "probes")

    def _work_pairs(self, probes: DataFrame) -> DataFrame:
        """``a, b, overlap``: classes of history that the works of a batch meet in a token."""
        near = F.when(F.col("kind") == "d", F.array("slot")).otherwise(F.array(F.col("slot") - 1, "slot", F.col("slot") + 1))
        look = probes.where(F.col("side") != POST).select("token", F.explode(near).alias("slot"), "kind", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("has_doi").alias("da"))
        held = self._read("postings", look.select("token")).select("token", "slot", F.col("ref").alias("b"), F.col("n").alias("nb"), F.col("has_doi").alias("db"))
        words_fit = F.when(F.col("kind") == "h", F.abs(F.col("na") - F.col("nb")) == 1).otherwise(F.col("na") == F.col("nb"))
        met = look.join(held, ["token", "slot"]).where((F.col("a") != F.col("b")) & words_fit & ((F.col("kind") == "d") | ~(F.col("da") & F.col("db"))))
        return met.groupBy("a", "b").agg(F.min(F.col("kind") == "w").alias("overlap")).select(F.lit("works").alias("entity"), "a", "b", "overlap")

    def _author_pairs(self, new: DataFrame) -> tuple[DataFrame, ...]:
        """``a, b`` of authors that share a context and nearly a word; the new postings, facet postings and facets."""
        at = new.where("entity = 'authors'").select("cls", "contexts", F.explode("facets").alias("facet"))
        node = F.concat(F.lit("f"), "facet")
        asked = at.select("facet").distinct()
        stood = self._read("nodes", asked.select(node.alias("node"))).where("node LIKE 'f%'").select(F.substring("node", 2, 1 << 30).alias("facet"), F.lit(True).alias("stood"))
        facets = materialize(asked.join(stood, "facet", "left"), "facets")
        fresh = facets.where("stood IS NULL")
        each = spread(facets, "facet").mapInPandas(_post_facets, "facet string, fresh boolean, token string, post boolean, probe boolean")
        tokens = materialize(each.select("facet", "fresh", F.xxhash64("token").alias("token"), "post", "probe"), "facettokens")
        posted = tokens.where("post AND fresh").select("token", "facet")
        look = tokens.where("probe").select("facet", "token")
        held = self._read("facets", look.select("token")).unionByName(posted).select("token", F.col("facet").alias("g"))
        met = look.join(held, "token").where((F.col("facet") != F.col("g")) & (F.abs(F.length("facet") - F.length("g")) <= 2))
        near = spread(met.select("facet", "g").distinct(), "facet", "g").mapInPandas(_near, "facet string, g string").unionByName(facets.select("facet", F.col("facet").alias("g")))
        near = materialize(near, "near")
        token = lambda c: F.concat(F.lit("a"), "context", F.lit(":"), c)
        placed = at.select("cls", F.explode("contexts").alias("context"), "facet")
        own, look = together(
            lambda: materialize(placed.select(token("facet").alias("token"), F.col("cls").alias("ref")).distinct(), "places"),
            lambda: materialize(placed.join(near, "facet").select(token("g").alias("token"), F.col("cls").alias("a")).distinct(), "looks"),
        )
        held = self._read("postings", look.select("token")).where("kind = 'a'").select("token", F.col("ref").alias("b"))
        met = look.join(held.unionByName(own.select("token", F.col("ref").alias("b"))), "token").where("a <> b")
        pairs = met.select(F.lit("authors").alias("entity"), "a", "b", F.lit(False).alias("overlap")).distinct()
        places = own.select("token", F.lit(0).alias("slot"), F.lit("a").alias("kind"), F.lit(0).alias("n"), "ref", F.lit(False).alias("has_doi"))
        return pairs, places, posted, fresh.select(node.alias("node"), F.lit("").alias("label"))

    def _resolve(self, nodes: DataFrame) -> DataFrame:
        """``node, label``: the present label of every node (one column) that stands in the index."""
        found = materialize(self._read("nodes", nodes).join(nodes.distinct(), "node", "left_semi").select("node", "label"), "labels")
        for _ in self.batches[1:]:  # as often as labels were merged in a row, at most once per batch
            step = materialize(found.join(self._read("merges", found.select("label")), "label", "left").select("node", F.coalesce("into", "label").alias("label"), "into"), "labels")
            found = step.select("node", "label")
            if step.where("into IS NOT NULL").isEmpty():
                break
        return found

    def add(self, features: DataFrame, batch_no: int) -> DataFrame:
        """Accept one batch of features with their class.

        Returns ``entity, batch_no, id_a, id_b`` of its repetitions of earlier batches.
        """
        if batch_no in self.batches:
            raise ValueError(f"batch {batch_no} was accepted before")
        self.size = features.count()
        head = F.min(F.struct(F.lit(batch_no).alias("batch_no"), "updated", "id")).alias("head")
        payload = [F.first(c).alias(c) for c in ("doi", "year", "words", "names", "contexts", "facets", "parts")]
        known = self._read("registry", features.select("cls")).select("cls", F.col("head").alias("known"))
        rows, classes = together(
            lambda: materialize(features.groupBy("entity", "id", "cls").agg(F.min("updated").alias("updated")).withColumn("node", F.concat_ws(":", F.lit("i"), "entity", "id")), "rows"),
            lambda: materialize(features.groupBy("entity", "cls").agg(head, *payload).join(known, "cls", "left"), "classes"),
        )
        new = classes.where("known IS NULL")
        if not self.batches:
            self.established = nm.established_names(new.where("entity = 'authors'").select(F.explode("names").alias("name")))
        common = self.established
        probes, (author_pairs, author_postings, facet_postings, facets) = together(lambda: self._probes(classes, batch_no), lambda: self._author_pairs(new))
        pairs = author_pairs
        if self.batches:  # in the first batch works need no partner: nothing earlier exists
            pairs = pairs.unionByName(self._work_pairs(probes))
        pairs = materialize(pairs, "pairs")
        contents = ["doi", "year", "words", "names", "contexts"]
        earlier = self._read("registry", pairs.select("b")).select("cls", "head", *contents)
        stored = earlier.unionByName(new.where("entity = 'authors'").select("cls", "head", *contents))
        side = lambda df, s, *more: df.select(F.col("cls").alias(s), *more, *[F.col(c).alias(f"{c}_{s}") for c in contents])
        both = pairs.join(side(classes, "a"), "a").join(side(stored, "b", F.col("head").alias("head_b")), "b")
        n = F.size("words_a")
        enough = F.size(F.array_intersect("words_a", "words_b")) >= n - F.greatest(F.when(n >= 4, 2).otherwise(1), F.floor(n / 3))
        matches = materialize(both.where(~F.col("overlap") | enough).mapInPandas(lambda batches: _verify(batches, common), f"entity string, a string, b string, head_b {_HEAD}"), "matches")
        tidy(self.spark)
        asked = rows.select("node").unionByName(classes.where("entity = 'authors' AND known IS NOT NULL").select(F.col("cls").alias("node"))).unionByName(matches.where("entity = 'authors'").select(F.col("b").alias("node")))
        stood = self._resolve(asked)
        rows = materialize(rows.join(stood.withColumnRenamed("label", "id_label"), "node", "left"), "rows")
        author_best, nodes = self._unite(rows.where("entity = 'authors'"), matches.where("entity = 'authors'").select("a", "b"), stood, batch_no)
        fresh = rows.where("id_label IS NULL")
        work_best = matches.where("entity = 'works'").select(F.col("a").alias("cls"), F.col("head_b").alias("best")).unionByName(classes.where("entity = 'works' AND known IS NOT NULL").select("cls", F.col("known").alias("best")))
        best = fresh.where("entity = 'works'").select("entity", "id", "cls").join(work_best, "cls").select("entity", "id", "best").unionByName(author_best.select(F.lit("authors").alias("entity"), "id", "best"))
        others = best.where(F.col("best.batch_no") < batch_no).groupBy("entity", "id").agg(F.min("best").alias("best")).select("entity", "id", F.col("best.id").alias("other")).where("id <> other")
        same = rows.where("id_label IS NOT NULL").select("entity", "id", F.col("id").alias("other"))
        out = same.unionByName(others).select("entity", F.lit(batch_no).alias("batch_no"), F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b"))
        postings = probes.where(F.col("side") != PROBE).join(new.select("cls"), "cls", "left_semi").select("token", "slot", "kind", "n", F.col("cls").alias("ref"), "has_doi").unionByName(author_postings)
        nodes = nodes.unionByName(fresh.where("entity = 'works'").select("node", F.col("node").alias("label")).distinct()).unionByName(facets)
        out = materialize(out.distinct(), "repeated")
        for name, df in (("postings", postings), ("facets", facet_postings), ("registry", new), ("nodes", nodes)):
            self._append(df, name, batch_no)
        self._finish(batch_no)
        tidy(self.spark)
        return out

    def _unite(self, rows: DataFrame, matches: DataFrame, stood: DataFrame, batch_no: int) -> tuple[DataFrame, DataFrame]:
        """Bring the author classes and ids of a batch together with what they equal, transitively.

        Nodes of the small graph are the batch's new classes and the labels of
        what it meets.  Labels begin with ``L``, which is less than any class,
        so the least node of a component is an older label if it has one.
        Returns ``id, best`` of the batch's new ids, the earliest record that is
        the same, and the new rows of ``nodes``.
        """
        label = stood.where("label LIKE 'L%'")
        point = lambda df, c: df.join(label.select(F.col("node").alias(c), F.col("label").alias("_l")), c, "left")
        placed = point(rows, "cls").select("node", "id", "cls", "updated", "id_label", F.coalesce("_l", "cls").alias("x"))
        placed = materialize(placed.withColumn("first", F.min("x").over(Window.partitionBy("id"))), "placed")
        of_ids = placed.select(F.col("first").alias("a"), F.explode(F.array_compact(F.array("x", "id_label"))).alias("b"))
        edges = materialize(point(matches, "b").select("a", F.coalesce("_l", "b").alias("b")).unionByName(of_ids).where("a <> b").distinct(), "union")
        parts = connected_components(edges)
        # what takes part in no edge is a component of its own
        member = placed.join(parts.select(F.col("node").alias("x"), "component"), "x", "left").withColumn("rep", F.coalesce("component", "x"))
        named = F.when(F.col("rep").startswith("L"), F.col("rep")).otherwise(F.concat(F.lit("L"), "rep"))
        member = materialize(member.select("node", "id", "cls", "updated", "id_label", "x", named.alias("rep")), "members")
        into = F.when(F.col("component").startswith("L"), F.col("component")).otherwise(F.concat(F.lit("L"), "component"))
        older = parts.where("node LIKE 'L%'").select(F.col("node").alias("label"), into.alias("rep")).unionByName(member.where("x LIKE 'L%'").select(F.col("x").alias("label"), "rep")).distinct()
        older = materialize(older, "older")
        before = self._read("best", older.select("label")).join(older, "label").select("rep", "best")
        here = member.select("rep", F.struct(F.lit(batch_no).alias("batch_no"), "updated", "id").alias("best"))
        best = before.unionByName(here).groupBy(F.col("rep").alias("label")).agg(F.min("best").alias("best"))
        best = materialize(best, "bests")
        self._append(older.where("label <> rep").select("label", F.col("rep").alias("into")), "merges", batch_no)
        self._append(best, "best", batch_no)
        ids = member.where("id_label IS NULL").select("node", "id", F.col("rep").alias("label")).distinct()
        fresh = member.where("x = cls").select(F.col("cls").alias("node"), F.col("rep").alias("label")).distinct()
        return ids.join(best, "label").select("id", "best"), fresh.unionByName(ids.select("node", "label"))


def repeated_records(works: DataFrame, authors: DataFrame, batches: list[int] | None = None) -> DataFrame:
    """``entity, batch_no, id_a, id_b`` over all batches, accepted one after the other."""
    features = work_features(works).unionByName(author_features(authors))
    features = materialize(with_class(features), "features")
    if batches is None:  # a handful of batch numbers
        batches = sorted(r[0] for r in features.select("batch_no").distinct().collect())
    out = empty(works.sparkSession, "entity string, batch_no int, id_a string, id_b string")
    with IncrementalIndex(works.sparkSession) as index:
        for b in batches:
            out = out.unionByName(index.add(features.where(F.col("batch_no") == b), b))
    return out
