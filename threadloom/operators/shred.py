"""Adjacency-table shredding of nested records.

A record becomes rows (doc, node, parent, label, ordinal, depth, kind, scalar): ``node`` is the path of the value,
``parent`` the path of what holds it, ``label`` its field name (an array element carries the array's name), ``ordinal``
its place, ``kind`` one of object, array, scalar, null. Object nodes joined with their scalar children and pivoted give
one flat table per kind of entity, each row tied to its record and place.

Defined cases: a null or empty record has no nodes but (if null) none at all; null elements are stored with kind
``null`` and keep their place; a lone object or scalar where an array is expected counts as an array of one; text that
holds no complete JSON object has no nodes; extra columns of the input are ignored; an empty table gives empty tables.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE_SCHEMA = T.StructType(
    [
        T.StructField("doc", T.LongType()),
        T.StructField("node", T.StringType()),
        T.StructField("parent", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("scalar", T.StringType()),
    ]
)


# --- typed columns: the walk over the schema is done while planning, the rows are made in the JVM -------------------


def _node(path: Column, parent: Column, label: Column, ordinal: Column, depth: int, kind: str, scalar: Column) -> Column:
    return F.struct(
        path.alias("node"),
        parent.alias("parent"),
        label.alias("label"),
        ordinal.cast("int").alias("ordinal"),
        F.lit(depth).alias("depth"),
        F.lit(kind).alias("kind"),
        scalar.cast("string").alias("scalar"),
    )


def _walk(
    value: Column, kind: T.DataType, path: Column, parent: Column, label: str, ordinal: Column, depth: int
) -> Column:
    name, nothing = F.lit(label), F.lit(None).cast("string")
    empty = F.array(_node(path, parent, name, ordinal, depth, "null", nothing))
    if isinstance(kind, T.StructType):
        own = F.array(_node(path, parent, name, ordinal, depth, "object", nothing))
        below = [
            _walk(value[f.name], f.dataType, F.concat(path, F.lit(f"/{f.name}")), path, f.name, F.lit(i), depth + 1)
            for i, f in enumerate(kind.fields)
        ]
        return F.when(value.isNull(), empty).otherwise(F.concat(own, *below))
    if isinstance(kind, T.ArrayType):
        own = F.array(_node(path, parent, name, ordinal, depth, "array", nothing))
        below = F.flatten(
            F.transform(
                value,
                lambda x, i: _walk(
                    x, kind.elementType, F.concat(path, F.lit("/"), i.cast("string")), path, label, i, depth + 1
                ),
            )
        )
        return F.when(value.isNull(), empty).otherwise(F.concat(own, below))
    return F.when(value.isNull(), empty).otherwise(
        F.array(_node(path, parent, name, ordinal, depth, "scalar", value))
    )


def shred_columns(df: DataFrame, doc: str, columns: list[str]) -> DataFrame:
    """Nodes of the typed nested ``columns`` of ``df``; ``doc`` is a long that names the record."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = [
        _walk(F.col(f"`{c}`"), kinds[c], F.lit(f"/{c}"), F.lit("/"), c, F.lit(i), 1) for i, c in enumerate(columns)
    ]
    return df.select(F.col(doc).alias("doc"), F.explode(F.concat(*parts)).alias("n")).select("doc", "n.*")


# --- JSON text of any shape and depth ------------------------------------------------------------------------------

_FENCE = re.compile(r"^\s*```[A-Za-z0-9_-]*\s*\n?|\n?\s*```\s*$")
_TRAILING_COMMA = re.compile(r",(\s*[}\]])")
_DECODER = json.JSONDecoder(parse_float=str, parse_int=str)


def decode_payload(text: str | None, unwrap: int = 4, decoder: json.JSONDecoder = _DECODER) -> dict | list | None:
    """The JSON object of a delivered text: bare, in a code fence, in a JSON string, or within other text.

    None if there is no complete object. By the default decoder numbers are text as they are spelt. A text that breaks off inside its outermost
    object holds no complete object, whatever complete parts lie in it.
    """
    for _ in range(unwrap):
        if text is None:
            return None
        text = _FENCE.sub("", text.strip().lstrip("\ufeff")).strip()
        try:
            found = decoder.decode(text)
        except (ValueError, RecursionError):
            return _scan(text, decoder)
        if isinstance(found, (dict, list)):
            return found
        if not isinstance(found, str):
            return None
        text = found
    return None


def _scan(text: str, decoder: json.JSONDecoder) -> dict | None:
    """The first complete object within a text that isn't JSON as a whole."""
    at = text.find("{")
    while at >= 0:
        for candidate in (text[at:], _TRAILING_COMMA.sub(r"\1", text[at:])):
            try:
                return decoder.raw_decode(candidate)[0]
            except RecursionError:
                return None
            except ValueError as error:
                broke_off = error.pos >= len(candidate.rstrip()) or "Unterminated" in error.msg
        if broke_off:
            return None
        at = text.find("{", at + 1)
    return None


def walk_json(root: dict | list) -> Iterator[tuple]:
    """(node, parent, label, ordinal, depth, kind, scalar) of every value, without recursion."""
    stack = [("", "", "", 0, 0, root)]
    while stack:
        node, parent, label, ordinal, depth, value = stack.pop()
        if isinstance(value, dict):
            yield node or "/", parent, label, ordinal, depth, "object", None
            for i, (k, v) in enumerate(value.items()):
                step = k.replace("~", "~0").replace("/", "~1")
                stack.append((f"{node}/{step}", node or "/", k, i, depth + 1, v))
        elif isinstance(value, list):
            yield node or "/", parent, label, ordinal, depth, "array", None
            for i, v in enumerate(value):
                stack.append((f"{node}/{i}", node or "/", label, i, depth + 1, v))
        elif value is None:
            yield node or "/", parent, label, ordinal, depth, "null", None
        else:
            text = ("true" if value else "false") if isinstance(value, bool) else str(value)
            yield node or "/", parent, label, ordinal, depth, "scalar", text


def shred_json(df: DataFrame, doc: str, payload: str) -> DataFrame:
    """Nodes of a column of JSON texts. Depth and shape differ by row, so this runs in Arrow batches of Python."""

    def shred(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = NODE_SCHEMA.fieldNames()
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch["doc"], batch["payload"]):
                found = decode_payload(text)
                if found is not None:
                    rows.extend((key, *n) for n in walk_json(found))
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    source = df.select(F.col(doc).cast("long").alias("doc"), F.make_valid_utf8(F.col(payload)).alias("payload"))
    return source.where("payload IS NOT NULL").mapInPandas(shred, NODE_SCHEMA)


# --- entities ------------------------------------------------------------------------------------------------------


def entities(nodes: DataFrame, labels: list[str], fields: list[str], scalar_as: str | None = None) -> DataFrame:
    """One row (doc, label, pos, <fields>) per non-null element of the arrays named by ``labels``.

    Of several nodes with one label in a record the one nearest to the root counts. An element's scalar children are
    joined to it and pivoted into ``fields``; a scalar element has null fields but for ``scalar_as``. Null elements
    count in ``pos`` but have no row.
    """
    heads = (
        nodes.where(F.col("label").isin(labels) & (F.col("kind") != "null"))
        .groupBy("doc", "label")
        .agg(F.min(F.struct("depth", "ordinal", "node", "kind", "scalar")).alias("h"))
        .select("doc", "label", "h.*")
    )
    inside = (
        heads.where("kind = 'array'")
        .select("doc", "label", F.col("node").alias("parent"))
        .join(nodes.where(F.col("label").isin(labels) & (F.col("kind") != "null")).drop("label"), ["doc", "parent"])
        .select("doc", "label", F.col("ordinal").alias("pos"), "node", "scalar")
    )
    lone = heads.where("kind <> 'array'").select("doc", "label", F.lit(0).alias("pos"), "node", "scalar")
    objects = inside.unionByName(lone)
    # The join of objects with their scalar children and the pivot share one shuffle: both sides come keyed by the
    # object's path, and one aggregation picks each field.
    own = objects.select(
        "doc", "node", "label", "pos", F.lit(None).cast("string").alias("field"), F.col("scalar").alias("value")
    )
    children = nodes.where((F.col("kind") == "scalar") & F.col("label").isin(fields)).select(
        "doc",
        F.col("parent").alias("node"),
        F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("int").alias("pos"),
        F.col("label").alias("field"),
        F.col("scalar").alias("value"),
    )
    picked = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    if scalar_as:
        at = fields.index(scalar_as)
        picked[at] = F.coalesce(
            F.max(F.when(F.col("field") == scalar_as, F.col("value"))),
            F.max(F.when(F.col("field").isNull(), F.col("value"))),
        ).alias(scalar_as)
    return (
        own.unionByName(children)
        .groupBy("doc", "node")
        .agg(F.max("label").alias("label"), F.max("pos").alias("pos"), *picked)
        .where(F.col("pos").isNotNull())
        .drop("node")
    )
