"""JSON / record-identity functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repsmith.functions._util import as_col, ColumnOrName


def json_text(doc: ColumnOrName, path: str) -> Column:
    """``doc ->> path``: scalar member as text; JSON null -> SQL NULL. ``path`` like ``$.a.b``."""
    return F.get_json_object(as_col(doc), path)


def json_doc(doc: ColumnOrName, path: str) -> Column:
    """``doc -> path``: sub-document kept as raw JSON text."""
    return F.get_json_object(as_col(doc), path)


def json_array_len(doc: ColumnOrName, path: str | None = None) -> Column:
    """Length of a JSON array member (``path=None``: the document itself). Not an array -> null."""
    d = as_col(doc) if path is None else F.get_json_object(as_col(doc), path)
    return F.json_array_length(d).cast("long")


def record_id(record: ColumnOrName) -> Column:
    """Stable identity: ``workout.id`` when a nested ``workout`` object exists, else top-level ``id``."""
    r = as_col(record)
    nested = F.get_json_object(r, "$.workout")
    return (F.when(nested.isNotNull() & F.startswith(F.ltrim(nested), F.lit("{")),
                   F.get_json_object(r, "$.workout.id"))
            .otherwise(F.get_json_object(r, "$.id")))


def content_hash(record: ColumnOrName) -> Column:
    """Key-order independent md5 of a JSON document.

    ``parse_json`` produces a VARIANT whose object keys are stored sorted, so the
    re-serialised text is canonical. A document that is not valid JSON (or repeats
    a key) hashes its raw text instead, so it is never silently merged with another.
    """
    r = as_col(record)
    canon = F.to_json(F.try_parse_json(r))
    return F.md5(F.coalesce(canon, r))


def columns_hash(*cols: ColumnOrName) -> Column:
    """md5 over typed columns (order-sensitive), via a JSON struct so nulls and types are explicit."""
    return F.md5(F.to_json(F.struct(*[as_col(c) for c in cols])))
