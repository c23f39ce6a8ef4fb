"""Nested-document operators.

Two shapes: ``explode_json_array`` keeps each element as raw JSON text (for generic,
schema-less documents), and ``flatten_two_levels`` parses a document once against a
declared schema whose leaves are strings, so every value keeps its exact text (UTC
offsets included) and is cast after the explode -- one parse per record instead of one
per field. ``explode`` (not ``explode_outer``) gives inner-unnest semantics: a null or
empty array drops its parent row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repsmith.functions._util import as_col, ColumnOrName


def explode_json_array(df: DataFrame, doc: ColumnOrName, path: str, out: str,
                       pos: str | None = None, outer: bool = False) -> DataFrame:
    """One row per element of the JSON array at ``path``; the element stays raw JSON text."""
    arr = F.from_json(F.get_json_object(as_col(doc), path), "array<string>")
    if pos:
        gen = F.posexplode_outer(arr) if outer else F.posexplode(arr)
        return df.select("*", gen.alias(pos, out))
    gen = F.explode_outer(arr) if outer else F.explode(arr)
    return df.select("*", gen.alias(out))


def _name(path: str) -> str:
    if not path.startswith("$.") or "." in path[2:] or "[" in path:
        raise ValueError(f"only top-level member paths like '$.name' are supported here: {path}")
    return path[2:]


def _ddl(fields: dict[str, tuple[str, str]], child: tuple[str, str] | None = None) -> str:
    """struct<...> DDL with every leaf read as STRING (raw text, cast after the parse)."""
    parts = [f"`{_name(p)}`: string" for p, _ in fields.values()]
    if child:
        parts.append(f"`{_name(child[0])}`: array<{child[1]}>")
    return "struct<" + ", ".join(dict.fromkeys(parts)) + ">"


def flatten_two_levels(df: DataFrame, doc: str, parent_fields: dict[str, tuple[str, str]],
                       level1_path: str, level1_fields: dict[str, tuple[str, str]],
                       level2_path: str, level2_fields: dict[str, tuple[str, str]],
                       keep: Sequence[str] = ()) -> DataFrame:
    """Document -> level-1 elements -> level-2 elements, keeping parent keys.

    ``*_fields`` map output name -> (``$.member`` inside that level, Spark type). The
    document is parsed once with ``from_json`` against a declared schema whose leaves are
    strings (numbers keep their exact text, nothing is inferred), both arrays are exploded
    (inner: a null or empty array drops its parent), and leaves are cast at the end.
    """
    l2 = _ddl(level2_fields)
    l1 = _ddl(level1_fields, (level2_path, l2))
    root = _ddl(parent_fields, (level1_path, l1))
    parsed = df.select(*keep, F.from_json(F.col(doc), root).alias("__d"))
    e1 = parsed.select(*keep, "__d", F.explode(F.col(f"__d.{_name(level1_path)}")).alias("__l1"))
    e2 = e1.select(*keep, "__d", "__l1", F.explode(F.col(f"__l1.{_name(level2_path)}")).alias("__l2"))
    cols = [F.col(k) for k in keep]
    cols += [F.col(f"__d.{_name(p)}").try_cast(t).alias(n) for n, (p, t) in parent_fields.items()]
    cols += [F.col(f"__l1.{_name(p)}").try_cast(t).alias(n) for n, (p, t) in level1_fields.items()]
    cols += [F.col(f"__l2.{_name(p)}").try_cast(t).alias(n) for n, (p, t) in level2_fields.items()]
    return e2.select(*cols)


def nested_length_sum(doc: ColumnOrName, level1_path: str, level2_path: str) -> Column:
    """Sum of the level-2 array lengths straight off the raw document, no explode
    (higher-order ``aggregate`` over the level-1 elements). A null/non-array counts 0."""
    l1 = F.from_json(F.get_json_object(as_col(doc), level1_path), "array<string>")
    lens = F.transform(F.coalesce(l1, F.array().cast("array<string>")),
                       lambda e: F.coalesce(F.json_array_length(F.get_json_object(e, level2_path)), F.lit(0)).cast("long"))
    return F.aggregate(lens, F.lit(0).cast("long"), lambda acc, x: acc + x)


def nest_children(children: DataFrame, parent_keys: Sequence[str], child_cols: Sequence[str],
                  array_name: str, max_children: int = 256) -> DataFrame:
    """Children -> one array column per parent, split so no array exceeds ~``max_children``.

    The child count per parent comes from a (map-side combined) count; parents with
    more than ``max_children`` children get ``ceil(n / max_children)`` salt buckets
    chosen by a hash of the child row, so a hot parent becomes several bounded groups
    instead of one unbounded ``collect_list`` in one task. The rows are then redistributed on
    (parent, chunk), so a hot parent's chunks are collected by different tasks (and the count
    join, no longer feeding the aggregation's partitioning directly, is left to AQE's skew
    splitting). Output: parent keys, ``__chunk``, ``array_name``.
    """
    pk = list(parent_keys)
    counts = children.groupBy(*pk).agg(F.count(F.lit(1)).alias("__n"))
    salted = (children.join(counts, pk)
              .withColumn("__buckets", F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(float(max_children)))).cast("long"))
              .withColumn("__chunk", F.pmod(F.xxhash64(*[F.col(c) for c in child_cols]), F.col("__buckets"))))
    return (salted.repartition(*[F.col(c) for c in pk], F.col("__chunk"))
            .groupBy(*pk, "__chunk")
            .agg(F.collect_list(F.struct(*[F.col(c) for c in child_cols])).alias(array_name)))


def pages_to_records(pages: DataFrame, records_key: str, page_col: str = "page",
                     pos_col: str = "pos", record_col: str = "record") -> DataFrame:
    """Paged API responses (``{"page": n, "page_count": m, "<records_key>": [...]}``) -> one row
    per record with its (page, position). A null list yields no rows."""
    arr = F.from_json(F.get_json_object(F.col("body"), f"$.{records_key}"), "array<string>")
    return (pages.select(F.get_json_object("body", "$.page").try_cast("long").alias(page_col),
                         F.get_json_object("body", "$.page_count").try_cast("long").alias("page_count"),
                         F.posexplode(arr).alias(pos_col, record_col))
            .withColumn(pos_col, F.col(pos_col).cast("long")))
