"""Digests and canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_id(subject: Column, business_key: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", subject, business_key), 256), 1, 32)


def payload_hash(canonical: Column) -> Column:
    return F.substring(F.sha2(canonical, 256), 1, 16)


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys; nulls are written."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def labels_key(labels: Column) -> Column:
    """A label map in its canonical order, as exposition text."""
    pairs = F.array_sort(F.map_entries(labels))
    return F.when(F.size(pairs) == 0, "").otherwise(F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"'))), ","), F.lit("}")))
