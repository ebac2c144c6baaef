"""Reading nested event documents as if they were flat.

A document is flattened to (dotted path, text, whether it is JSON ``true``). Objects are opened level by level, so a path may
be spelled nested, as one literal dotted key, or as any mix of both. An object is not a value; of a
list the first element counts; JSON null keeps its path but has no text. Of two spellings of one path
in a document the later one counts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import parse_number

ENTRIES = "array<struct<key:string,raw:string,value:variant>>"


def repeated_keys_allowed(frame: DataFrame) -> DataFrame:
    """Lets the session read JSON objects that repeat a key; the last one counts. They would read as no object otherwise."""
    frame.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return frame


def _children(value: Column) -> Column:
    """Key and value pairs of an object, null for anything else."""
    return F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))


def _leaf_text(value: Column) -> Column:
    text = F.try_variant_get(value, "$", "string")
    # Text that does not start like a list or an object is neither; most values stop here.
    plain = ~text.startswith("[") & ~text.startswith("{")
    is_list = F.try_variant_get(value, "$", "array<variant>").isNotNull()
    is_object = F.try_variant_get(value, "$", "map<string,variant>").isNotNull()
    return F.when(plain, text).when(is_list, F.try_variant_get(value, "$[0]", "string")).when(~is_object, text)


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def _is_true(value: Column) -> Column:
    """Whether a value, or the first of a list, is JSON true and not a text that says so."""
    shown = F.try_variant_get(value, "$", "string")
    kind = lambda place: F.schema_of_variant(F.try_variant_get(value, place, "variant")) == "BOOLEAN"
    return F.coalesce((shown == "true") & kind("$"), F.lit(False)) | F.coalesce(shown.startswith("[true") & kind("$[0]"), F.lit(False))


def _texts_of(json_text: Column, pairs: Column, paths: Sequence[str]) -> Column:
    wanted = F.filter(pairs, lambda e: e["key"].isin(list(paths)) & ~F.coalesce(_is_object(e["value"]), F.lit(False)))
    # Most documents do not hold the word at all.
    is_true = lambda e: F.when(json_text.contains("true"), _is_true(e["value"])).otherwise(F.lit(False))
    return F.transform(wanted, lambda e: F.struct(e["key"].alias("path"), _leaf_text(e["value"]).alias("text"), is_true(e).alias("is_true")))


def _ordered_children(raw: Column, above: Column | None = None) -> Column:
    """(key, raw text, value) of an object in the order of the text, which variants do not keep."""
    texts, values = (F.map_entries(F.from_json(raw, f"map<string,{kind}>")) for kind in ("string", "variant"))

    def entry(text: Column, value: Column) -> Column:
        key = text["key"] if above is None else F.concat(above, F.lit("."), text["key"])
        return F.struct(key.alias("key"), text["value"].alias("raw"), value["value"].alias("value"))

    return F.zip_with(texts, values, entry)


def _later_spelling(json_text: Column, paths: Sequence[str], depth: int) -> Column:
    """The pairs of a document that spells a path twice: parsed again in its own order, the last one counts."""
    pairs = F.coalesce(_ordered_children(json_text), F.array().cast(ENTRIES))
    for _ in range(depth):
        inner = lambda e: _ordered_children(F.when(_is_object(e["value"]), e["raw"]), e["key"])
        pairs = F.flatten(F.transform(pairs, lambda e: F.coalesce(inner(e), F.array(e))))
    texts = F.reverse(_texts_of(json_text, pairs, paths))
    return F.transform(
        F.array(texts), lambda t: F.filter(t, lambda e, i: F.array_position(t["path"], e["path"]) == i + 1)
    )[0]


def _plain_texts(paths: Sequence[str]) -> Callable[[pd.Series], pd.Series]:
    """A reader of plain documents: the text of each path in order, then those of ``paths`` that occur, one a line.

    Null for a document that is not plain: not an object, a path spelled twice, JSON true, numbers beyond 18 digits, escaped
    surrogates, lists that hold more than texts and whole numbers, long or deep ones, and whatever this parser refuses.
    """
    places = {path: n for n, path in enumerate(paths)}
    above = {".".join(path.split(".")[:n]) for path in paths for n in range(1, path.count(".") + 1)}

    def whole(shown: str) -> int:
        if len(shown) > 18:
            raise ValueError(shown)
        return int(shown)

    def decimal(shown: str) -> str:
        # As a decimal prints: no exponent, no zeros at the end.
        if len(shown) > 18 or "e" in shown or "E" in shown:
            raise ValueError(shown)
        short = shown.rstrip("0").rstrip(".")
        return "0" if short in ("-0", "") else short

    def refuse(name: str):
        raise ValueError(name)

    # Fractions become texts of their own kind, as a list may not hold them.
    class Fraction(str):
        pass

    def text(value) -> str | None:
        if value is None or isinstance(value, str):
            return value
        if value is False:
            return "false"
        if type(value) is int:
            return str(value)
        if isinstance(value, list) and value and type(value[0]) in (str, int) and all(type(v) in (str, int) for v in value):
            return text(value[0])
        raise ValueError(value)

    def read(document: str | None, decoder: json.JSONDecoder) -> list[str | None] | None:
        # Longer and deeper ones could meet limits of the other parser.
        if document is None or len(document) > 40_000 or document.count("{") + document.count("[") > 500 or "true" in document or "\\ud" in document or "\\uD" in document:
            return None
        found: list[str | None] = [None] * (len(places) + 1)
        seen = []

        def walk(entries: dict, before: str) -> None:
            for key, value in entries.items():
                path = before + key
                if isinstance(value, dict):
                    if path in above:
                        walk(value, path + ".")
                elif path in places:
                    found[places[path]] = text(value)
                    seen.append(path)

        try:
            entries = decoder.decode(document)
            if not isinstance(entries, dict):
                return None
            walk(entries, "")
        except (ValueError, RecursionError):
            return None
        if len(set(seen)) < len(seen):
            return None
        found[-1] = "\n".join(seen)
        return found

    def texts(documents: pd.Series) -> pd.Series:
        decoder = json.JSONDecoder(parse_float=lambda shown: Fraction(decimal(shown)), parse_int=whole, parse_constant=refuse)
        return pd.Series([read(document, decoder) for document in documents], dtype=object)

    return texts


def plain_texts(json_text: Column, paths: Sequence[str]) -> Column:
    """Texts of ``paths`` in a plain document, then the paths that occur; null where :func:`flatten_document` has to read it."""
    read = F.pandas_udf(_plain_texts(tuple(paths)), "array<string>")
    return read(F.when(F.is_valid_utf8(json_text), json_text))


def flatten_document(json_text: Column, paths: Sequence[str]) -> Column:
    """array<struct<path, text, is_true>> of those paths that occur in a JSON object.

    Only objects under the first segments of the paths are opened, and only as deep as the paths go.
    """
    roots = sorted({path.split(".")[0] for path in paths})
    depth = max(path.count(".") for path in paths)
    nothing = F.array().cast("array<struct<key:string,value:variant>>")
    pairs = F.coalesce(_children(F.try_parse_json(json_text)), nothing)
    pairs = F.filter(pairs, lambda e: F.substring_index(e["key"], ".", 1).isin(roots))

    def open_pair(entry: Column) -> Column:
        inner = F.transform(
            _children(entry["value"]),
            lambda child: F.struct(
                F.concat(entry["key"], F.lit("."), child["key"]).alias("key"), child["value"].alias("value")
            ),
        )
        return F.coalesce(inner, F.array(entry))

    for _ in range(depth):
        pairs = F.flatten(F.transform(pairs, open_pair))
    # The array of one names the value, so that it is computed once.
    return F.transform(
        F.array(_texts_of(json_text, pairs, paths)),
        lambda found: F.when(
            F.size(F.array_distinct(found["path"])) < F.size(found), _later_spelling(json_text, paths, depth)
        ).otherwise(found),
    )[0]


def leaf(json_text: Column, path: str) -> Column:
    """Text at one dotted path of a JSON object; null if absent. A path of one segment has one spelling and is asked for by name."""
    if "." not in path and "'" not in path:
        value = F.try_variant_get(F.try_parse_json(json_text), f"$['{path}']", "variant")
        return F.when(~F.coalesce(_is_object(value), F.lit(False)), _leaf_text(value))
    return F.get(flatten_document(json_text, [path]), F.lit(0))["text"]


def any_value(json_text: Column, path: str, wanted: str) -> Column:
    """Whether the value at a dotted path, nested or spelled as one key, is ``wanted``, or is a list that holds it."""
    document = F.try_parse_json(json_text)
    places = ["$." + path, f"$['{path}']"]
    in_list = [F.array_contains(F.try_variant_get(document, place, "array<string>"), wanted) for place in places]
    return F.coalesce(leaf(json_text, path) == wanted, F.lit(False)) | F.coalesce(*in_list, F.lit(False))


def first_present(*values: Column, default: str | None = "") -> Column:
    """The first value that is neither null nor empty. ``0`` and ``false`` count as present."""
    candidates = [F.nullif(value, F.lit("")) for value in values]
    return F.coalesce(*candidates, F.lit(default)) if default is not None else F.coalesce(*candidates)


def to_float(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(parse_number(value), F.lit(default))


def to_int(value: Column, default: int = 0) -> Column:
    """Truncates toward zero. Whole numbers of 64 bits stay as they are."""
    return F.coalesce(parse_number(value).try_cast("long"), F.lit(default).cast("long"))
