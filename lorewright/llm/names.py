"""Variant spellings of names: who is the same person or group.

Two records are linked when one of their names can be read as one name and
they share a context (institution or ORCID); links are transitive.

Every name is parsed into given names and family name, or the words and the
acronym of a group.  The parts that two names must nearly share (each family
name, the group's words, its acronym) become vectors of character trigrams
weighted by inverse document frequency.  Within a context a sparse cosine join
pairs those that share one of their heaviest trigrams: in a global order from
rare to common, vectors of cosine t or more must share a trigram of the prefix
whose remainder has norm below t, so nothing is lost by the prefix.  All pairs
above the threshold are kept, not the best n of each: a cap would lose links.
Names that hold a similar part are read against each other (initials,
nicknames, slips, swapped order, double names, acronyms).

What reads as one is grouped by closure: since two that both equal a third are
the same, a linkage that cuts weak chains (average linkage) would part what
belongs together.  One rule holds for every size of group.

Equal names in one context form one node with a star of links to its smallest
id, so a name that holds a third of all rows stays linear until the result;
crowded contexts are joined in chunk pairs.

Defined cases: NULL and blank ids, names, institutions and ORCIDs count as
missing; without a context no link; rows of one id pool their names and
contexts; an alternative that merely abbreviates the record's fuller name is
no name of its own; exact duplicates and empty tables give no pairs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorewright.functions.ids import bare_id, bare_orcid
from lorewright.llm.components import connected_components
from lorewright.llm.hot import merge_join, split_join
from lorewright.session import materialize

#: Short forms of given names and what they commonly stand for (fixed values).
NICKNAMES = {
    "abby": "abigail", "al": "albert alfred alexander", "alex": "alexander alexandra", "alf": "alfred", "ali": "alicia", "andy": "andrew andrea", "angie": "angela",
    "barb": "barbara", "barbie": "barbara", "bastian": "sebastian", "bea": "beatrix beatrice", "becky": "rebecca", "bella": "isabella", "ben": "benjamin", "benny": "benjamin",
    "bernie": "bernhard bernard", "bert": "albert herbert", "beth": "elisabeth elizabeth", "betty": "elisabeth elizabeth", "bill": "william", "billy": "william", "bob": "robert",
    "bobby": "robert", "cathy": "catherine", "charlie": "charles", "chris": "christopher christian christina", "chuck": "charles", "connie": "constance", "dan": "daniel", "danny": "daniel",
    "dave": "david", "davy": "david", "deb": "deborah", "debbie": "deborah", "dick": "richard", "dolly": "dorothea", "dora": "dorothea theodora", "dot": "dorothea", "ed": "edward edmund",
    "eddie": "edward edmund", "ellie": "eleonora", "ernie": "ernest", "essie": "esther", "flo": "florian florence", "fran": "frances franziska", "franzi": "franziska", "frank": "francis",
    "fred": "frederick alfred", "freddy": "frederick alfred", "fritz": "frederick friedrich", "gabe": "gabriel", "gabby": "gabriel gabriela", "gene": "eugenia eugene", "genie": "eugenia",
    "gerry": "gerald gerard", "gertie": "gertrude", "greg": "gregory", "gus": "gustav augustus", "hal": "harold henry", "hanna": "johanna hannah", "harry": "harold henry", "hetty": "henrietta",
    "hettie": "henrietta", "izzy": "isabella isidor", "jack": "john", "jake": "jacob", "jerry": "gerald jeremias jeremiah", "jim": "james", "jimmy": "james", "jo": "josephine johanna joachim",
    "joe": "joseph joachim", "joey": "joseph", "jon": "jonathan", "josie": "josephine", "jules": "julian julia", "kate": "catherine katarina katherine", "kathy": "catherine katarina katherine",
    "katie": "catherine katarina katherine", "katya": "katarina catherine", "ken": "kenneth", "kit": "christopher", "larry": "laurence lawrence", "len": "leonard", "lena": "magdalena helena",
    "lenny": "leonard", "leo": "leopold leonard", "libby": "elisabeth elizabeth", "lisa": "elisabeth elizabeth", "liz": "elisabeth elizabeth", "lizzie": "elisabeth elizabeth", "lou": "louis louise",
    "luke": "lucas", "maggie": "margaret magdalena", "marc": "marcus", "mark": "marcus", "marty": "martin", "matt": "matthew", "meg": "margaret", "mick": "michael", "mike": "michael",
    "mina": "wilhelmina", "minna": "wilhelmina", "mitch": "michael", "nat": "nathaniel natalia", "nate": "nathaniel", "ned": "edward", "nell": "eleonora helena", "nick": "nicholas", "nico": "nicholas",
    "ollie": "oliver", "pam": "pamela", "pat": "patricia patrick", "patty": "patricia", "peg": "margaret", "peggy": "margaret", "pete": "peter", "phil": "philippa philip", "pippa": "philippa",
    "raf": "rafael", "ray": "raimund raymond", "rick": "richard", "rob": "robert", "robbie": "robert", "ron": "ronald", "rosie": "rosalind", "roz": "rosalind", "sam": "samuel samantha",
    "sandy": "alexander alexandra", "seb": "sebastian", "sol": "solveig", "steve": "stefan stephen", "sue": "susanna", "susie": "susanna", "suzy": "susanna", "ted": "edward theodor", "thea": "theodora dorothea",
    "theo": "theodora theodor", "tilly": "matilda", "tim": "timothy", "tom": "thomas", "tommy": "thomas", "tony": "anton anthony", "trixie": "beatrix", "ursi": "ursula", "val": "valentin valeria",
    "vera": "veronica", "vic": "victoria victor", "vicky": "victoria", "vince": "vincent", "vinny": "vincent", "wally": "walter", "walt": "walter", "will": "william", "willy": "william",
    "zach": "zacharias", "zack": "zacharias",
}

#: Words that mark a group, and words without weight in its name (fixed values).
GROUP_WORDS = {"group", "team", "consortium", "collaboration", "party", "network", "project", "initiative", "committee", "alliance", "society", "working", "study", "survey", "taskforce"}
STOP_WORDS = {"the", "on", "of", "for", "and", "in", "a", "an", "de", "der", "die", "das", "la", "le", "el"}
TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "sir", "phd", "md", "jr", "sr"}

Name = tuple[str, tuple[str, ...], tuple[str, ...]]
"""kind ('p' person, 'g' group), given names or group words, family names or acronym"""


def fold(text: str) -> str:
    """Lower case without accents; digits that look like letters become letters inside words."""
    t = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    return re.sub(r"(?<=[a-z])[01](?=[a-z01]|\b)|\b[01](?=[a-z])", lambda m: "o" if m[0] == "0" else "l", t)


def _group(raw: list[str]) -> Name | None:
    inner = [t for t in raw if fold(t) not in STOP_WORDS]
    words = [fold(t) for t in inner]
    plain = [w for w in words if w not in GROUP_WORDS]
    shouted = [fold(t) for t in inner if t.isupper() and 3 <= len(t) <= 8 and fold(t) not in GROUP_WORDS]
    initials = "".join(w[0] for w in words)
    if len(plain) == 1 and shouted == plain and not all(t.isupper() for t in inner):
        return ("g", (), (plain[0],))
    if len(words) >= 3 and words[-1] == initials[:-1]:  # the acronym stands behind the name
        words = words[:-1]
        initials = initials[:-1]
    return ("g", tuple(sorted(words)), (initials,))


@lru_cache(maxsize=65536)
def parse_name(text: str) -> Name | None:
    """A person's given and family names, or a group's words; None for text without letters."""
    text = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text)).strip()
    bare = re.sub(r"[^\w\s,.'’\-]", " ", text)
    if re.fullmatch(r"[A-Z]{3,8}", bare.strip()):
        return ("g", (), (bare.strip().lower(),))
    tokens = [t for t in re.findall(r"[^\W_]+(?:[-'’][^\W_]+)*", bare) if fold(t) not in TITLES]
    if not tokens:
        return None
    if any(fold(t) in GROUP_WORDS for t in tokens) and len(tokens) >= 2:
        return _group(tokens)
    family, _, after = bare.partition(",")
    if after.strip() and re.search(r"\w", family):
        last = re.findall(r"[^\W_]+(?:[-'’][^\W_]+)*", family)
        given = [t for t in re.findall(r"[^\W_]+(?:[-'’][^\W_]+)*", after) if fold(t) not in TITLES]
        if not last:
            last, given = given[-1:], given[:-1]
    elif len(tokens) >= 2 and len(tokens[-1]) <= 3 and tokens[-1].isupper() and len(tokens[0]) > 3:
        last, given = tokens[:1], [*tokens[1:-1], *tokens[-1]]
    elif len(tokens) >= 2 and len(tokens[-1]) <= 2 and len(tokens[0]) > 3 and all(len(t) <= 2 for t in tokens[1:]):
        last, given = tokens[:1], [c for t in tokens[1:] for c in t]
    elif len(tokens) >= 2 and len(tokens[0]) > 2 and tokens[0].isupper() and not any(t.isupper() and len(t) > 2 for t in tokens[1:]):
        last, given = tokens[:1], tokens[1:]
    else:
        last, given = tokens[-1:], tokens[:-1]
    parts = tuple(p for t in last for p in re.split(r"[-'’]", fold(t)) if p)
    names = tuple(p for t in given for p in re.split(r"[-'’]", fold(t)) if p)
    return ("p", names, parts) if parts else None


def parse_alternatives(text: str | None) -> list[str]:
    """Names in a JSON list, a Python list, or text split at ``;`` or ``,``.

    ``Family, Given`` is one name: a comma only separates where both sides have
    several words, or an initial with a family name.
    """
    s = (text or "").strip()
    if not s:
        return []
    if s.startswith("["):
        try:
            return [x for x in json.loads(s) if isinstance(x, str) and x.strip()]
        except ValueError:
            return [b or a for a, b in re.findall(r"'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\"", s) if (a or b).strip()]
    if ";" in s:
        return [p.strip() for p in s.split(";") if p.strip()]
    out: list[str] = []
    pieces = [p.strip() for p in s.split(",") if p.strip()]
    i = 0
    while i < len(pieces):
        single = len(pieces[i].split()) == 1
        if single and i + 1 < len(pieces):
            out.append(f"{pieces[i]}, {pieces[i + 1]}")
            i += 2
        else:
            out.append(pieces[i])
            i += 1
    return out


def slips(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, or ``most + 1`` when it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            v = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, older[j - 2] + 1)
            row[j] = v
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def close(a: str, b: str, one: int, two: int) -> bool:
    """Equal, or within one slip from ``one`` letters on, two from ``two`` on."""
    if a == b:
        return True
    short = min(len(a), len(b))
    most = 2 if short >= two else 1 if short >= one else 0
    return most > 0 and (slips(a, b, most) <= most or slips(a.replace("rn", "m"), b.replace("rn", "m"), most) <= most)


def _readings(given: str) -> tuple[str, ...]:
    return (given, *NICKNAMES.get(given, "").split())


def _given(a: str, b: str, established: frozenset[str] = frozenset()) -> bool:
    """One given name in two writings; two names that are both common are no slips of each other."""
    if len(a) == 1 or len(b) == 1:
        full, initial = (a, b) if len(b) == 1 else (b, a)
        return any(r[0] == initial for r in _readings(full))
    return any(x == y or (not {x, y} <= established and close(x, y, 4, 6)) for x in _readings(a) for y in _readings(b))


def same_name(a: Name, b: Name, established: frozenset[str] = frozenset()) -> bool:
    """Whether two parsed names can be read as one; ``established`` holds the common given names."""
    if a[0] != b[0]:
        return False
    if a[0] == "g":
        if not a[1] or not b[1]:
            if a[2][0] == b[2][0]:
                return True
            long, short = (a, b) if a[1] else (b, a)
            plain = "".join(w[0] for w in long[2][0]) if not short[1] else ""
            return bool(long[1]) and not short[1] and plain != "" and short[2][0] == long[2][0]
        if len(a[1]) != len(b[1]):
            return False
        rest = list(b[1])
        for w in a[1]:
            hit = next((r for r in rest if close(w, r, 4, 8)), None)
            if hit is None:
                return False
            rest.remove(hit)
        return True
    if not any(close(x, y, 5, 8) for x in a[2] for y in b[2]):
        return False
    if not a[1] or not b[1]:
        return False
    return all(_given(x, y, established) for x, y in zip(a[1], b[1]))


def _abbreviates(short: Name, full: Name) -> bool:
    """``short`` says nothing that ``full`` does not say."""
    if short == full:
        return True
    if short[0] != "p" or full[0] != "p" or len(short[1]) > len(full[1]) or not set(short[2]) <= set(full[2]):
        return False
    less = len(short[1]) < len(full[1]) or any(len(x) < len(y) for x, y in zip(short[1], full[1])) or len(short[2]) < len(full[2])
    return less and all(x == y or (len(x) == 1 and x == y[0]) for x, y in zip(short[1], full[1]))


def names_of(display: Iterable[str | None], alternatives: Iterable[str | None]) -> list[Name]:
    """The distinct names of a record, without mere abbreviations of fuller ones."""
    texts = [t for t in display if t and t.strip()] + [x for a in alternatives for x in parse_alternatives(a)]
    parsed = sorted({p for t in texts if (p := parse_name(t)) is not None})
    kept: list[Name] = []
    for n in parsed:
        if not any(m != n and _abbreviates(n, m) and not (_abbreviates(m, n) and m > n) for m in parsed):
            kept.append(n)
    return kept


def facets(name: Name) -> set[str]:
    """The strings that names must nearly share to be read as one: family names, a group's words, its acronym."""
    if name[0] == "p":
        return set(name[2])
    return {*name[2], *([" ".join(name[1])] if name[1] else [])} - {""}


def trigrams(facet: str) -> set[str]:
    out: set[str] = set()
    for w in facet.split():
        s = f"^{w.replace('rn', 'm')}$"
        out.update(s[i : i + 3] for i in range(len(s) - 2))
    return out


def encode(name: Name) -> str:
    return "|".join((name[0], " ".join(name[1]), " ".join(name[2])))


def decode(text: str) -> Name:
    kind, given, family = text.split("|")
    return (kind, tuple(given.split()), tuple(family.split()))


def author_names(rows: DataFrame) -> DataFrame:
    """``id, name, contexts`` for every distinct name of every id."""
    r = rows.select(
        bare_id(F.col("id")).alias("id"),
        F.col("display_name").alias("d"),
        F.col("display_name_alternatives").alias("a"),
        F.array_compact(
            F.array(F.concat(F.lit("i"), bare_id(F.col("last_known_institution"))), F.concat(F.lit("o"), bare_orcid(F.col("orcid"))))
        ).alias("c"),
    ).where("id IS NOT NULL")
    # the few distinct writings of an id, not its rows, are gathered
    distinct = r.distinct()
    pooled = distinct.groupBy("id").agg(F.collect_set("d").alias("d"), F.collect_set("a").alias("a"), F.array_distinct(F.flatten(F.collect_set("c"))).alias("contexts"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [[encode(n) for n in names_of(d, a)] for d, a in zip(b["d"], b["a"])]
            yield pd.DataFrame({"id": b["id"], "names": found, "contexts": b["contexts"]})

    named = pooled.mapInPandas(parse, "id string, names array<string>, contexts array<string>")
    return named.select("id", F.explode("names").alias("name"), "contexts")


def _facets(names: DataFrame) -> DataFrame:
    """``name, facet`` of the distinct names."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(n, f) for n in b["name"] for f in sorted(facets(decode(n)))]
            yield pd.DataFrame(rows, columns=["name", "facet"])

    return names.mapInPandas(split, "name string, facet string")


def _vectors(distinct: DataFrame) -> DataFrame:
    """``facet, gram, df, weight``: unit vectors of the distinct facets, weighted by inverse document frequency."""

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(f, g) for f in b["facet"] for g in sorted(trigrams(f))]
            yield pd.DataFrame(rows, columns=["facet", "gram"])

    g = materialize(distinct.mapInPandas(grams, "facet string, gram string"), "grams")
    total = distinct.agg(F.count("*").alias("n"))
    df = g.groupBy("gram").agg(F.count("*").alias("df"))
    # the root damps the rare trigrams that a slip makes
    weighted = merge_join(g, df, "gram").withColumn("w", F.sqrt(F.log(F.lit(1.0) + total.scalar() / F.col("df"))))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("facet")))
    return weighted.withColumn("weight", F.col("w") / norm).select("facet", "gram", "df", "weight")


def similar_facets(placed: DataFrame, threshold: float) -> DataFrame:
    """``context, fa, fb``, fa < fb: facets of one context with a cosine of at least ``threshold``.

    Only trigrams of the prefix are joined: in the order from rare to common,
    the rest of a vector whose norm is below the threshold cannot make two
    vectors similar by itself.
    """
    vectors = materialize(_vectors(placed.select("facet").distinct()), "vectors")
    w = Window.partitionBy("facet").orderBy("df", "gram").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.lit(1.0) - F.coalesce(F.sum(F.col("weight") * F.col("weight")).over(w), F.lit(0.0))
    prefix = vectors.withColumn("rest", rest).where(F.col("rest") >= threshold * threshold - 1e-9).select("facet", "gram")
    at = merge_join(placed, prefix, "facet")
    at = materialize(at.select("context", "gram", "facet"), "prefixes")
    met = split_join(at.withColumnRenamed("facet", "fa"), at.withColumnRenamed("facet", "fb"), ["context", "gram"], "fa", "fb")
    pairs = materialize(met.where("fa < fb").select("context", "fa", "fb").distinct(), "facetpairs")
    lists = vectors.groupBy("facet").agg(F.map_from_entries(F.collect_list(F.struct("gram", "weight"))).alias("v"))
    dot = F.aggregate(F.map_entries("va"), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(F.col("vb"), e["key"]), F.lit(0.0)))
    both = merge_join(pairs.select("fa", "fb").distinct(), lists.select(F.col("facet").alias("fa"), F.col("v").alias("va")), "fa")
    both = merge_join(both, lists.select(F.col("facet").alias("fb"), F.col("v").alias("vb")), "fb")
    close = both.where(dot >= threshold).select("fa", "fb")
    return merge_join(pairs, close, ["fa", "fb"]).select("context", "fa", "fb")


def established_names(named: DataFrame, share: float = 0.002, least: int = 5) -> frozenset[str]:
    """First given names that at least this share of the persons in ``named`` (column ``name``) bear; at most 1 / share of them."""
    person = named.where(F.col("name").startswith("p|")).select(F.split(F.split("name", r"\|")[1], " ")[0].alias("given")).where(F.length("given") > 1)
    counts = person.groupBy("given").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    return frozenset(r[0] for r in counts.where((F.col("n") >= least) & (F.col("n") >= F.lit(share) * total.scalar())).select("given").collect())


def similar_names(named: DataFrame, threshold: float = 0.28, established: frozenset[str] = frozenset()) -> DataFrame:
    """``context, na, nb``: distinct names that share a context and read as one.

    ``named`` has ``context, name`` distinct.
    """

    def readable(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[[same_name(decode(x), decode(y), established) for x, y in zip(b["na"], b["nb"])]]

    holds = materialize(merge_join(named, _facets(named.select("name").distinct()), "name").select("context", "facet", "name"), "facets")
    placed = materialize(holds.select("context", "facet").distinct(), "placed")
    near = similar_facets(placed, threshold).unionByName(placed.select("context", F.col("facet").alias("fa"), F.col("facet").alias("fb")))
    left, right = holds.select("context", F.col("facet").alias("fa"), F.col("name").alias("x")), holds.select("context", F.col("facet").alias("fb"), F.col("name").alias("y"))
    near = materialize(merge_join(near, left, ["context", "fa"]), "near")  # a common family name of a large institution has many names on both sides
    met = split_join(near, right, ["context", "fb"], "x", "y").where((F.col("fa") < F.col("fb")) | (F.col("x") < F.col("y"))).where("x <> y")
    pairs = materialize(met.select("context", F.least("x", "y").alias("na"), F.greatest("x", "y").alias("nb")).distinct(), "namepairs")
    texts = pairs.select("na", "nb").distinct()
    return merge_join(pairs, texts.mapInPandas(readable, texts.schema), ["na", "nb"]).select("context", "na", "nb")


def author_links(rows: DataFrame, threshold: float = 0.28) -> DataFrame:
    """``a, b``: links between ids; equal names of a context link to its smallest id."""
    named = materialize(author_names(rows), "names")
    at = named.select("id", "name", F.explode("contexts").alias("context"))
    heads = materialize(at.groupBy("context", "name").agg(F.min("id").alias("head")), "heads")
    star = merge_join(at, heads, ["context", "name"]).where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"))
    read = similar_names(heads.select("context", "name"), threshold, established_names(named.select("name")))  # over distinct names, not ids
    first = heads.select("context", F.col("name").alias("na"), F.col("head").alias("ha"))
    second = heads.select("context", F.col("name").alias("nb"), F.col("head").alias("hb"))
    across = merge_join(merge_join(read, first, ["context", "na"]), second, ["context", "nb"]).where("ha <> hb")
    return star.unionByName(across.select(F.least("ha", "hb").alias("a"), F.greatest("ha", "hb").alias("b"))).distinct()


def author_clusters(rows: DataFrame, threshold: float = 0.28) -> DataFrame:
    """``id, cluster`` of every id that is linked to another."""
    return clusters_of(materialize(author_links(rows, threshold), "links"))


def clusters_of(links: DataFrame) -> DataFrame:
    """``id, cluster``: the closure of the links, whatever the size of a group; its least id names it."""
    return connected_components(links, join=merge_join).select(F.col("node").alias("id"), F.col("component").alias("cluster"))


def cluster_pairs(clusters: DataFrame) -> DataFrame:
    """All pairs of a cluster, smaller id first."""
    c = clusters.select("cluster", "id")
    return merge_join(c.select("cluster", F.col("id").alias("author_a")), c.select("cluster", F.col("id").alias("author_b")), "cluster").where("author_a < author_b").select("author_a", "author_b")
