"""Identities: pair names and product fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = "yyyyMMdd'T'HHmmss"


def pair_id(first_time: Column, second_time: Column, first_id: Column, second_id: Column) -> Column:
    """Both start times plus eight hex digits over the scene ids: same-date pairs never collide."""
    digest = F.substring(F.sha2(F.concat_ws("|", first_id.cast("string"), second_id.cast("string")), 256), 1, 8)
    return F.concat_ws("_", F.date_format(first_time, STAMP), F.date_format(second_time, STAMP), digest)


def sorted_json(mapping: Column) -> Column:
    """A string map as JSON text with sorted keys, one canonical spelling per content."""
    entries = F.array_sort(F.map_entries(mapping))
    quoted = lambda s: F.concat(F.lit('"'), F.regexp_replace(s, r'(["\\])', r"\\$1"), F.lit('"'))
    parts = F.transform(entries, lambda kv: F.concat(quoted(kv["key"]), F.lit(": "), quoted(kv["value"])))
    return F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))


def fingerprint(first_hash: Column, second_hash: Column, code_hash: Column, resources: Column, config: Column) -> Column:
    """SHA-256 over input hashes, code hash, sorted resource hashes and canonical configuration text."""
    return F.sha2(F.concat(first_hash, second_hash, code_hash, sorted_json(resources), config), 256)
