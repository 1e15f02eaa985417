"""Text, list and inverted-index expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lorewright.functions.ids import strip_all


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once: inside a lambda a plain expression is computed anew for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def omit_empty(c: Column) -> Column:
    """NULL for empty text, so that ``to_json`` leaves the key out."""
    return F.nullif(F.coalesce(c, F.lit("")), F.lit(""))


def parse_alternatives(c: Column) -> Column:
    """Alternative names as an array.

    Empty gives ``[]``; a JSON array is read as such; other JSON scalars become
    a one-element list; otherwise ``;`` separates, else ``,``, else the whole
    text is the only element.  Parts are stripped and empty parts dropped.
    """
    s = strip_all(c)

    def split_on(sep: str) -> Column:
        return F.filter(F.transform(F.split(s, sep), strip_all), lambda x: x != "")

    as_json = F.from_json(s, "array<string>", {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    is_list = s.startswith("[") & as_json.isNotNull()
    scalar = F.get_json_object(F.concat(F.lit('{"v":'), s, F.lit("}")), "$.v")
    return (
        F.when(s == "", F.array().cast("array<string>"))
        .when(is_list, F.filter(as_json, lambda x: x.isNotNull()))
        .when(s.rlike(r'^(".*"|-?\d+(\.\d+)?|true|false)$') & scalar.isNotNull(), F.array(scalar))
        .when(s.contains(";"), split_on(";"))
        .when(s.contains(","), split_on(","))
        .otherwise(F.array(s))
    )


def parse_inverted_index(c: Column) -> Column:
    """JSON text ``{word: [positions]}`` as a map; blank or invalid gives NULL."""
    m = F.from_json(c, "map<string,array<int>>")
    return F.when(F.size(m) > 0, m)


def reconstruct_abstract(c: Column) -> Column:
    """Words of an inverted index in position order, joined by one blank.

    Gaps collapse.  Where two words claim one position, the later key of the
    JSON object wins, which needs the order of the keys: entries are numbered,
    and of equal positions the one of the highest number is kept.
    """
    entries = F.map_entries(parse_inverted_index(c))
    flat = F.flatten(
        F.transform(
            entries,
            lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("p"), i.alias("i"), e["key"].alias("w"))),
        )
    )

    def words(ordered: Column) -> Column:
        kept = F.filter(ordered, lambda x, i: F.coalesce(F.get(ordered, i + 1)["p"] != x["p"], F.lit(True)))
        return F.array_join(F.transform(kept, lambda x: x["w"]), " ")

    return let(F.array_sort(flat), words)


def build_inverted_index(c: Column) -> Column:
    """Map from each blank-separated word to its ascending positions."""
    words = F.filter(F.split(strip_all(c), r"\s+"), lambda w: w != "")

    def positions(ws: Column) -> Column:
        def of(k: Column) -> Column:
            return F.filter(F.transform(ws, lambda w, i: F.when(w == k, i)), lambda p: p.isNotNull())

        return let(F.array_distinct(ws), lambda keys: F.map_from_arrays(keys, F.transform(keys, of)))

    return let(words, positions)


def title_and_abstract(title: Column, abstract: Column) -> Column:
    return strip_all(F.concat(text_or_empty(title), F.lit(" "), text_or_empty(abstract)))


def numeric_or_null(c: Column) -> Column:
    """A plain decimal number as double; NULL for everything else, type suffixes included."""
    s = strip_all(c)
    return F.when(s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), s.try_cast("double"))
