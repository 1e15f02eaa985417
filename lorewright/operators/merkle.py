"""Nested records as a store of distinct objects: Merkle subtree identities.

Every JSON object of a record, and every array that stands directly in an
array, is canonicalised and hashed bottom-up; its identity is the hash of a
canonical JSON text of its kind, its scalar fields, the lengths of its arrays
and its typed links to what lies below.  Equal subtrees therefore have equal
identities wherever they occur and are stored once; different ones cannot be
written as the same text.  What a record looked like is kept by

* ``records``: record id -> identity of its root object, or why it has none,
* ``objects``: identity -> canonical JSON of the scalar fields, array lengths,
* ``bridges``: parent identity, field, ordinal -> child identity, or the value
  and its JSON type where the element of an array is a scalar.  ``listed`` is
  false for a field that is one bare object.

Records are walked without recursion, so their depth is not bounded.

Defined cases: a field that is null and a field that is missing are the same;
of repeated field names the last counts; a bare object has ordinal 0, like the
only element of an array; null elements of arrays have no bridge, but keep
their place in the ordinals and count in the array's length; text that is no
JSON, is cut off, or is not an object gives a record without root and with a
``problem``; an empty table gives empty tables; lone surrogates become U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from json.decoder import scanstring
from json.scanner import NUMBER_RE
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.functions.ids import bare_id
from lorewright.session import materialize

_LINK = pa.struct([("field", pa.string()), ("ordinal", pa.int32()), ("listed", pa.bool_()), ("child", pa.string()), ("value", pa.string()), ("type", pa.string())])
_ARROW = pa.schema(
    [
        ("record", pa.int64()), ("problem", pa.string()), ("node", pa.string()), ("is_root", pa.bool_()), ("kind", pa.string()),
        ("id", pa.string()), ("payload", pa.string()), ("arrays", pa.string()), ("children", pa.list_(_LINK)),
    ]
)
_SCHEMA = (
    "record bigint, problem string, node string, is_root boolean, kind string, id string, payload string, arrays string, "
    "children array<struct<field:string,ordinal:int,listed:boolean,child:string,value:string,type:string>>"
)
_SPACE = re.compile(r"[ \t\n\r]*")
_WORDS = {"true": True, "false": False, "null": None}


def _no_constant(text: str) -> Any:
    raise ValueError(text)


def _dump(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def _clean(text: str) -> str:
    try:
        text.encode()
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text


def _parse_deep(text: str) -> Any:
    """JSON of any depth: the open containers are a list instead of calls."""
    open_: list[tuple[Any, str | None]] = []
    at = _SPACE.match(text, 0).end()

    def key(at: int) -> tuple[str, int]:
        if text[at : at + 1] != '"':
            raise ValueError(at)
        name, at = scanstring(text, at + 1, True)
        at = _SPACE.match(text, at).end()
        if text[at : at + 1] != ":":
            raise ValueError(at)
        return name, _SPACE.match(text, at + 1).end()

    while True:
        c = text[at : at + 1]
        if c and c in "{[":
            at = _SPACE.match(text, at + 1).end()
            value: Any = {} if c == "{" else []
            if text[at : at + 1] != ("}" if c == "{" else "]"):
                name = None
                if c == "{":
                    name, at = key(at)
                open_.append((value, name))
                continue
            at += 1
        elif c == '"':
            value, at = scanstring(text, at + 1, True)
        elif number := NUMBER_RE.match(text, at):
            whole, part, power = number.groups()
            value, at = (float(whole + (part or "") + (power or "")) if part or power else int(whole)), number.end()
        else:
            word = re.compile(r"[a-z]*").match(text, at)[0]
            if word not in _WORDS:
                raise ValueError(at)
            value, at = _WORDS[word], at + len(word)
        while open_:  # put the value in its container; close those that end here
            holder, name = open_.pop()
            if name is None:
                holder.append(value)
            else:
                holder[name] = value
            at = _SPACE.match(text, at).end()
            c = text[at : at + 1]
            at += 1
            if c == ",":
                at = _SPACE.match(text, at).end()
                if name is not None:
                    name, at = key(at)
                open_.append((holder, name))
                break
            if c != ("]" if name is None else "}"):
                raise ValueError(at)
            value = holder
        else:
            if _SPACE.match(text, at).end() != len(text):
                raise ValueError(at)
            return value


def _parse(text: str | None) -> tuple[dict | None, str | None]:
    """The record's object, or why there is none: ``blank``, ``broken`` or ``no object``."""
    if text is None or not text.strip():
        return None, "blank"
    try:
        try:
            value = json.loads(text, parse_constant=_no_constant)
        except RecursionError:
            value = _parse_deep(text)
    except ValueError:
        return None, "broken"
    return (value, None) if isinstance(value, dict) else (None, "no object")


def _scalar(value: Any) -> tuple[str, str]:
    """Text and JSON type."""
    if isinstance(value, str):
        return _clean(value), "string"
    return _dump(value), "boolean" if isinstance(value, bool) else "number"


def _walk(root: dict, opaque: frozenset[str], seen: Callable[[str, dict | list], None] | None = None) -> list[tuple[dict | None, str, Any, dict, dict, list]]:
    """Every container below ``root``, parents before children: link that names it, kind, id, scalars, array lengths, links."""
    order = []
    todo: list[tuple[dict | list, dict | None, str]] = [(root, None, "")]
    while todo:
        value, link, under = todo.pop()
        scalars: dict[str, Any] = {}
        arrays: dict[str, int] = {}
        links: list[dict] = []
        is_object = isinstance(value, dict)
        if seen and is_object and link is not None:
            seen(under, link)

        def below(field: str, ordinal: int, listed: bool, item: Any, todo=todo, links=links, under=under) -> None:  # noqa: ANN001
            entry = {"field": _clean(field), "ordinal": ordinal, "listed": listed, "child": None, "value": None, "type": None}
            if isinstance(item, (dict, list)):
                entry["type"] = "object" if isinstance(item, dict) else "array"
                todo.append((item, entry, field or under))
            else:
                entry["value"], entry["type"] = _scalar(item)
            links.append(entry)

        for field in sorted(value) if is_object else [""]:
            v = value[field] if is_object else value
            if v is None:
                continue
            if isinstance(v, (dict, list)) and field in opaque:
                try:
                    scalars[field] = json.loads(_dump(v))
                    continue
                except RecursionError:
                    pass  # too deep to stay text: stored like any other part
            if isinstance(v, dict):
                below(field, 0, False, v)
            elif isinstance(v, list):
                arrays[_clean(field)] = len(v)
                for ordinal, item in enumerate(v):
                    if item is not None:
                        below(field, ordinal, True, item)
            else:
                scalars[field] = v
        order.append((link, "object" if is_object else "array", scalars.get("id"), scalars, arrays, links))
    return order


def _nodes(root: dict, opaque: frozenset[str], out: dict[str, tuple], seen: Callable[[str, dict], None] | None = None) -> str:
    """Identity of ``root``; it and everything below it is added to ``out``."""
    node = ""
    for link, kind, key, scalars, arrays, links in reversed(_walk(root, opaque, seen)):
        payload, lengths = _clean(_dump(scalars)), _dump(arrays)
        content = json.dumps([kind, payload, lengths, [[x["field"], x["ordinal"], x["listed"], x["type"], x["child"], x["value"]] for x in links]])
        node = hashlib.blake2b(content.encode(), digest_size=16).hexdigest()
        if node not in out:
            out[node] = (kind, None if key is None or isinstance(key, (dict, list)) else _scalar(key)[0], payload, lengths, links)
        if link is not None:
            link["child"] = node
    return node


def _decompose(batches: Iterable[pa.RecordBatch], opaque: frozenset[str]) -> Iterator[pa.RecordBatch]:
    sys.set_int_max_str_digits(0)  # a long number is a number
    for batch in batches:
        out: dict[str, tuple] = {}
        ids, roots, problems = batch.column(0).to_pylist(), [], []
        for text in batch.column(1):
            obj, problem = _parse(text.as_py())
            roots.append(None if obj is None else _nodes(obj, opaque, out))
            problems.append(problem)
        n, m, top = len(ids), len(out), set(roots)
        columns = [ids + [None] * m, problems + [None] * m, roots + list(out), [None] * n + [x in top for x in out]]
        columns += [[None] * n + [v[k] for v in out.values()] for k in range(5)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


@dataclass(frozen=True)
class ObjectStore:
    records: DataFrame
    nodes: DataFrame

    @property
    def objects(self) -> DataFrame:
        return self.nodes.select("node", "kind", "payload", "arrays")

    @property
    def bridges(self) -> DataFrame:
        return self.nodes.select(F.col("node").alias("parent"), F.inline("children"))


def _texts(df: DataFrame, record_id: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{record_id}`").cast("bigint").alias("record"), F.col(f"`{text}`").cast("string").alias("text"))


def build_store(df: DataFrame, record_id: str, text: str, opaque: Sequence[str] = ("abstract_inverted_index",)) -> ObjectStore:
    """Decompose one JSON text per row; ``record_id`` is a unique bigint column.

    Fields named in ``opaque`` stay as canonical JSON in their object.  Parsing
    is one pass in Arrow batches; objects repeated within a batch leave it
    once, and one shuffle on the identity makes them distinct.
    """
    hidden = frozenset(opaque)
    long = materialize(_texts(df, record_id, text).mapInArrow(lambda batches: _decompose(batches, hidden), _SCHEMA), "objects")
    first = [F.first(c).alias(c) for c in ("kind", "id", "payload", "arrays", "children")]
    nodes = long.where("record IS NULL").groupBy("node").agg(F.max("is_root").alias("is_root"), *first)
    return ObjectStore(records=long.where("record IS NOT NULL").select("record", F.col("node").alias("root"), "problem"), nodes=materialize(nodes, "nodes"))


def _count(batches: Iterable[pa.RecordBatch], opaque: frozenset[str]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("field", pa.string()), ("child", pa.string()), ("n", pa.int64())])
    sys.set_int_max_str_digits(0)
    for batch in batches:
        uses: Counter[tuple[str, str]] = Counter()
        for text in batch.column(0):
            obj, _ = _parse(text.as_py())
            if obj is not None:
                named: list[tuple[str, dict]] = []
                _nodes(obj, opaque, {}, lambda field, link: named.append((field, link)))  # noqa: B023
                uses.update((_clean(f), link["child"]) for f, link in named)
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in uses], pa.string()), pa.array([c for _, c in uses], pa.string()), pa.array(list(uses.values()), pa.int64())], schema=schema)


def object_uses(df: DataFrame, text: str, opaque: Sequence[str] = ("abstract_inverted_index",)) -> DataFrame:
    """``field, child, n``: how often each nested object occurs under a parent field, at any depth.

    Occurrences are added up while the records are walked, so depth costs no
    rounds.  Objects of arrays within arrays count under the field of the
    outermost array.
    """
    hidden = frozenset(opaque)
    counted = df.select(F.col(f"`{text}`").cast("string")).mapInArrow(lambda batches: _count(batches, hidden), "field string, child string, n bigint")
    return counted.groupBy("field", "child").agg(F.sum("n").alias("n"))


def field(name: str, payload: str = "payload") -> Column:
    """A scalar field of an object, as text."""
    return F.get_json_object(payload, f"$.{name}")


def _readable(c: Column) -> Column:
    raw = F.trim(c)
    return F.nullif(F.coalesce(bare_id(raw), raw), F.lit(""))


def flat_rows(store: ObjectStore) -> DataFrame:
    """Every row that works records yield: ``record, src_table, item_pos, work_id, child_id, institutions, detail``.

    ``institutions`` (place, id) are those of an authorship; ``detail`` is the
    payload of the work, authorship or topic.  Three joins: what an authorship
    names, over distinct authorships; what a work names, over distinct works;
    and, by root identity, the occurrences of each work.
    """
    nodes = store.nodes.where("kind = 'object'").select("node", "is_root", _readable(F.col("id")).alias("id"), "payload", "children")
    named = nodes.where("id IS NOT NULL").select("node", "id", "payload")
    works = nodes.where("is_root AND id IS NOT NULL").select(F.col("node").alias("root"), F.col("id").alias("work_id"), "payload", "children")
    places = "array<struct<place:int,id:string>>"
    no_places = F.lit(None).cast(places)
    # what every authorship names
    below = nodes.where(F.exists("children", lambda c: (c["field"] == "author") & ~c["listed"])).select(F.col("node").alias("parent"), F.inline(F.filter("children", lambda c: (c["type"] == "object") & c["field"].isin("author", "institutions"))))
    found = below.join(named.select(F.col("node").alias("child"), "id"), "child")
    author = F.max(F.when((F.col("field") == "author") & ~F.col("listed"), F.col("id")))
    seats = F.array_sort(F.collect_list(F.when(F.col("field") == "institutions", F.struct(F.col("ordinal").alias("place"), "id"))))
    ships = found.groupBy("parent").agg(author.alias("id"), seats.cast(places).alias("institutions")).where("id IS NOT NULL")
    payloads = nodes.select(F.col("node").alias("parent"), "payload")
    entries = ships.join(payloads, "parent").select(F.col("parent").alias("child"), F.lit("authorships").alias("field"), F.col("id").alias("child_id"), "institutions", F.col("payload").alias("detail"))
    entries = entries.unionByName(named.select(F.col("node").alias("child"), F.lit("topics").alias("field"), F.col("id").alias("child_id"), no_places.alias("institutions"), F.col("payload").alias("detail")))
    # what every work names
    links = works.select("root", "work_id", F.inline(F.filter("children", lambda c: c["field"].isin("authorships", "topics", "referenced_works"))))
    objects = links.where("child IS NOT NULL AND field IN ('authorships', 'topics')").select("root", "work_id", "field", "ordinal", "child")
    rows = objects.join(entries, ["child", "field"]).select("root", F.concat(F.lit("works_"), "field").alias("src_table"), "ordinal", "work_id", "child_id", "institutions", "detail")
    references = links.where("field = 'referenced_works' AND value IS NOT NULL").select("root", F.lit("works_referenced_works").alias("src_table"), "ordinal", "work_id", _readable(F.col("value")).alias("child_id"), no_places.alias("institutions"), F.lit(None).cast("string").alias("detail"))
    own = works.select("root", F.lit("works").alias("src_table"), F.lit(0).alias("ordinal"), "work_id", F.col("work_id").alias("child_id"), no_places.alias("institutions"), F.col("payload").alias("detail"))
    every = own.unionByName(rows).unionByName(references.where("child_id IS NOT NULL"))
    return store.records.where("root IS NOT NULL").select("record", "root").join(every, "root").drop("root").withColumnRenamed("ordinal", "item_pos")


def flat_works(store: ObjectStore) -> dict[str, DataFrame]:
    """Flat tables of works records, one row per record and place.

    Columns: ``record, item_pos, work_id`` and the child's own ids; an
    authorship has a row per institution, or one without.
    """
    rows = flat_rows(store)

    def part(name: str, child: str) -> DataFrame:
        return rows.where(F.col("src_table") == name).withColumnRenamed("child_id", child).drop("src_table")

    ships = part("works_authorships", "author_id").select("*", F.explode_outer("institutions").alias("i"))
    return {
        "works": part("works", "_id").select("record", "item_pos", "work_id", *[field(c, "detail").alias(c) for c in ("doi", "title", "publication_year", "publication_date", "type", "language")]),
        "works_authorships": ships.select("record", "item_pos", "work_id", "author_id", F.col("i.id").alias("institution_id"), F.col("i.place").alias("institution_pos"), *[field(c, "detail").alias(c) for c in ("author_position", "raw_affiliation_string")]),
        "works_topics": part("works_topics", "topic_id").select("record", "item_pos", "work_id", "topic_id", field("score", "detail").alias("score")),
        "works_referenced_works": part("works_referenced_works", "referenced_work_id").select("record", "item_pos", "work_id", "referenced_work_id"),
    }
