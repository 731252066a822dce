"""Validation without coercion, missing fields, fill-only merge, and the roll-up of statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from factloom.functions.text import let
from factloom.schemas import FAILED, GROUPS, PARTIAL, RECORDS, SUCCESS


def parsed(json: Column) -> Column:
    return F.try_parse_json(json)


def _strings_only(v: Column, fields: list[str]) -> Column:
    ok = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    for f in fields:
        kind = F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant"))
        ok = ok & F.coalesce(kind == "STRING", F.lit(True))
    return ok


def is_valid(json: Column, fields: list[str]) -> Column:
    """An object whose known fields, where present, are strings; unknown keys are ignored, malformed JSON is invalid."""
    return let(parsed(json), lambda v: _strings_only(v, fields))


def to_record(json: Column, fields: list[str]) -> Column:
    """Known string fields as a map; missing ones are empty; an invalid reply gives null."""

    def record(v: Column) -> Column:
        pairs = [x for f in fields for x in (F.lit(f), F.coalesce(F.try_variant_get(v, f"$.{f}", "string"), F.lit("")))]
        return F.when(_strings_only(v, fields), F.create_map(*pairs))

    return let(parsed(json), record)


def targets(group: str) -> list[str]:
    return [f for g in GROUPS.get(group, ()) for f in g.target_fields]


def missing(data: Column, fields: list[str]) -> Column:
    """Target fields that are absent or empty, in order."""
    return F.filter(F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>"), lambda f: F.coalesce(data[f], F.lit("")) == "")


def affected(group: str, missing_fields: Column) -> Column:
    """Names of the sub-groups with a missing target, in order of configuration."""
    tests = [F.when(F.arrays_overlap(F.array(*map(F.lit, g.target_fields)), missing_fields), F.lit(g.name)) for g in GROUPS.get(group, ())]
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")


def merge(old: Column, new: Column, allowed: Column, fields: list[str]) -> Column:
    """Fills empty allowed fields from new; a field's quote only where the field was just filled and has none."""
    pairs = []
    value = lambda m, f: F.coalesce(m[f], F.lit(""))
    for f in fields:
        main = f.removesuffix("_quote")
        fill = F.array_contains(allowed, main) & (value(old, main) == "") & (value(new, main) != "")
        if f != main:
            fill = fill & F.map_contains_key(new, f)
        pairs += [F.lit(f), F.when(F.coalesce(fill, F.lit(False)) & (value(old, f) == ""), value(new, f)).otherwise(value(old, f))]
    return F.create_map(*pairs)


def as_struct(data: Column, group: str) -> Column:
    return F.struct(*[F.coalesce(data[f], F.lit("")).alias(f) for f in RECORDS[group]])


def roll_up(results: DataFrame) -> DataFrame:
    """(doc_id, field_name, status, raw_response) -> (doc_id, status): failed if no group replied, partial if any is not whole."""
    any_raw = F.bool_or(F.coalesce(F.col("raw_response"), F.lit("")) != "")
    whole = F.bool_and(F.col("status") == SUCCESS)
    return results.groupBy("doc_id").agg(F.when(~any_raw, FAILED).when(whole, SUCCESS).otherwise(PARTIAL).alias("status"))
