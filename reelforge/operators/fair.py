"""Provenance fields of sidecars: injection, order of keys, and the constraints of a JSON Schema as column checks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The field that names the parent, by type of document; documents of text have none.
PARENT_FIELD = {
    "face_crop": "parent_clip",
    "quality_annotation": "parent_crop",
    "transcription": "parent_clip",
    "person_clip": "parent_clip",
    "image_detection": "parent_clip",
}
# The keys that stand first in a sidecar, in this order.
FIRST_KEYS = ("uuid", "schema_version", "source", "parent_clip", "parent_audio", "parent_crop")
SCHEMA_VERSION = "1.0"
LICENSE = "public-domain"
SOURCE = "struct<archive_org_id:string,archive_org_url:string,license:string>"


def _column(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def with_fair_fields(df: DataFrame, kind: str, new_uuid: Column, parent_uuid: Column, parent_file: Column, org_id: Column, org_url: Column) -> DataFrame:
    """Adds uuid and schema_version where they are missing, the parent by type of document, and the source with its license.

    Empty and null identifiers count as none. A source that names a license keeps it; without any identifier a
    source that is there stays as it is.
    """
    some = [F.nullif(c, F.lit("")) for c in (parent_uuid, parent_file, org_id, org_url)]
    out = df.withColumns({"uuid": F.coalesce(_column(df, "uuid", "string"), new_uuid), "schema_version": F.coalesce(_column(df, "schema_version", "string"), F.lit(SCHEMA_VERSION))})
    if field := PARENT_FIELD.get(kind):
        parent = F.struct(parent_uuid.cast("string").alias("uuid"), parent_file.cast("string").alias("file"))
        known = _column(df, field, "struct<uuid:string,file:string>")
        out = out.withColumn(field, F.when(some[0].isNotNull() | some[1].isNotNull(), parent).otherwise(known))
    source = _column(df, "source", SOURCE)
    told = F.struct(
        F.coalesce(some[2], source["archive_org_id"]).alias("archive_org_id"), F.coalesce(some[3], source["archive_org_url"]).alias("archive_org_url"), F.coalesce(source["license"], F.lit(LICENSE)).alias("license")
    )
    return out.withColumn("source", F.when(some[2].isNotNull() | some[3].isNotNull(), told).otherwise(source))


def fair_order(columns: list[str]) -> list[str]:
    """Names with those of provenance first; all others keep their order."""
    return [c for c in FIRST_KEYS if c in columns] + [c for c in columns if c not in FIRST_KEYS]


# --- JSON Schema ---------------------------------------------------------------------------------


def _is(v: Column, kind: str) -> Column:
    """Whether a variant is of a JSON type; whole numbers are integers however they are written."""
    name = F.schema_of_variant(v)
    number = name.rlike(r"^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)")
    tests = {
        "string": name == "STRING", "object": name.startswith("OBJECT"), "array": name.startswith("ARRAY"), "boolean": name == "BOOLEAN", "null": name == "VOID", "number": number,
        "integer": number & (F.try_variant_get(v, "$", "double") == F.floor(F.try_variant_get(v, "$", "double"))),
    }
    return tests[kind]


def _at(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def schema_rules(schema: Mapping[str, Any], v: Column, path: str = "") -> Iterator[tuple[str, Column]]:
    """(name, condition that holds) of every constraint of a schema on a variant; a value that is absent breaks none but 'required'."""
    there = v.isNotNull()

    def rule(name: str, holds: Column) -> tuple[str, Column]:
        return f"{path or '$'}:{name}", ~there | F.coalesce(holds, F.lit(False))

    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds or []
    if kinds:
        typed = _is(v, kinds[0])
        for k in kinds[1:]:
            typed = typed | _is(v, k)
        yield rule("type", typed)
    text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
    if "enum" in schema:
        yield rule("enum", _is(v, "string") & text.isin(*schema["enum"]))
    if "pattern" in schema:
        yield rule("pattern", ~_is(v, "string") | text.rlike(schema["pattern"]))
    if "minimum" in schema:
        yield rule("minimum", ~_is(v, "number") | (number >= schema["minimum"]))
    items = F.try_variant_get(v, "$", "array<variant>")
    for word, test in (("minItems", lambda n: F.size(items) >= n), ("maxItems", lambda n: F.size(items) <= n)):
        if word in schema:
            yield rule(word, ~_is(v, "array") | test(schema[word]))
    if "items" in schema:
        yield rule("items", ~_is(v, "array") | F.forall(items, lambda x: _all(schema_rules(schema["items"], x))))
    for key in schema.get("required", ()):
        yield rule(f"required {key}", ~_is(v, "object") | _at(v, key).isNotNull())
    if "oneOf" in schema:
        fits = sum((_all(schema_rules(s, v)).cast("int") for s in schema["oneOf"]), F.lit(0))
        yield rule("oneOf", fits == 1)
    if schema.get("additionalProperties") is False:
        extra = F.array_except(F.json_object_keys(F.to_json(v)), F.array(*[F.lit(k) for k in schema.get("properties", {})]))
        yield rule("additionalProperties", ~_is(v, "object") | (F.size(extra) == 0))
    for key, inner in schema.get("properties", {}).items():
        yield from schema_rules(inner, _at(v, key), f"{path}.{key}" if path else key)


def _all(rules: Iterator[tuple[str, Column]]) -> Column:
    out = F.lit(True)
    for _, holds in rules:
        out = out & holds
    return out


def schema_violations(document: Column, schema: Mapping[str, Any]) -> Column:
    """Sorted names of the constraints that a JSON text breaks; a text that is no JSON breaks 'json'."""
    v = F.try_parse_json(document)
    rules = [("json", v.isNotNull()), *schema_rules(schema, v)]
    return F.array_sort(F.filter(F.array(*[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules]), lambda x: x.isNotNull()))


# --- volatile keys -------------------------------------------------------------------------------

PLACEHOLDER = "<volatile>"


def masked_json(document: Column, volatile: tuple[str, ...]) -> Column:
    """A JSON text with the values of volatile keys masked at every depth, separators of paths made alike, and keys sorted.

    Documents have any shape, so this one runs over Arrow batches; a text that is no JSON stays as it is.
    """

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        import json

        def walk(x):
            if isinstance(x, dict):
                return {k: PLACEHOLDER if k in volatile else walk(v) for k, v in x.items()}
            if isinstance(x, list):
                return [walk(v) for v in x]
            return x.replace("\\", "/") if isinstance(x, str) else x

        def one(t):
            try:
                return None if t is None else json.dumps(walk(json.loads(t)), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
            except ValueError:
                return t

        return texts.map(one, na_action="ignore")

    return mask(document)
