"""A conversation record from a model's payload: values outside the taxonomy replaced, absent keys filled, the rest kept.

The payload stays a map of variants, so keys and numbers that the schema doesn't name pass through as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.operators.extract import known_language, known_pattern, known_tools
from tessera.schema import SPEC_FIELDS, TAXONOMY, Taxonomy

MAP = "map<string,variant>"


def payload(json_text) -> Column:
    """The keys and values of a JSON object; null for anything else."""
    return F.try_variant_get(F.try_parse_json(json_text), "$", MAP)


def _is(value, kind: str) -> Column:
    """kind: OBJECT or ARRAY. Null or another kind: false."""
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def _variant(value) -> Column:
    """A string as a variant; null becomes JSON's null."""
    return F.coalesce(value.cast("variant"), F.parse_json(F.lit("null")))


def with_keys(given: Column, replaced: dict[str, Column], defaults: dict[str, Column]) -> Column:
    """given, a map, with some values replaced and absent ones set; a null column stands for a key to leave out."""
    fresh = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in replaced.items()]
    fresh += [F.struct(F.lit(k).alias("key"), F.when(~F.map_contains_key(given, F.lit(k)), v).alias("value")) for k, v in defaults.items()]
    names = F.array(*(F.lit(k) for k in replaced))
    kept = F.map_filter(given, lambda k, v: ~F.array_contains(names, k)) if replaced else given
    return F.map_concat(kept, F.map_from_entries(F.filter(F.array(*fresh), lambda x: x["value"].isNotNull())))


def _snippets(array, language: Column, tax: Taxonomy) -> Column:
    """A variant array of code snippets: objects in an unknown language get the record's."""

    def one(s: Column) -> Column:
        mine = F.try_variant_get(s, "$.language", "string")
        known = F.coalesce(mine.isin(*tax.languages), F.lit(False))
        return F.when(_is(s, "OBJECT") & ~known, F.to_variant_object(with_keys(F.try_variant_get(s, "$", MAP), {"language": _variant(language)}, {}))).otherwise(s)

    return F.to_variant_object(F.transform(F.try_variant_get(array, "$", "array<variant>"), one))


def _messages(array, language: Column, tax: Taxonomy) -> Column:
    def one(m: Column) -> Column:
        code = F.try_variant_get(m, "$.code_snippets", "variant")
        fixed = F.to_variant_object(with_keys(F.try_variant_get(m, "$", MAP), {"code_snippets": _snippets(code, language, tax)}, {}))
        return F.when(_is(code, "ARRAY"), fixed).otherwise(m)

    return F.to_variant_object(F.transform(F.try_variant_get(array, "$", "array<variant>"), one))


def assembled(given: Column, index: Column, record_id: Column, usage: Column, tax: Taxonomy = TAXONOMY, seed: int | None = None, model: str | None = None, source: str = "openrouter") -> Column:
    """The record's JSON from the payload `given` (a map column) and the row's coordinates.

    usage: a struct of token counts. Null if metadata is there but not an object: nothing can be added to it.
    """
    at = lambda k: F.try_element_at(given, F.lit(k))
    as_text = lambda k: F.try_variant_get(at(k), "$", "string")
    language = known_language(as_text("language"), tax)
    pattern = as_text("interaction_pattern")
    spec = F.to_variant_object(F.create_map(*(x for f in SPEC_FIELDS for x in (F.lit(f), F.col(f)))))
    parameters = F.struct(spec.alias("coverage_matrix"), F.lit(model).alias("model"), index.alias("sample_index"))
    made_by = F.struct(F.lit("tessera").alias("name"), F.lit("1").alias("version"), F.lit(seed).cast("long").alias("seed"), parameters.alias("parameters"))
    metadata = F.coalesce(F.try_variant_get(at("metadata"), "$", MAP), F.create_map().cast(MAP))
    replaced = {
        "tools": F.to_variant_object(known_tools(F.filter(F.transform(F.try_variant_get(at("tools"), "$", "array<variant>"), lambda t: F.try_variant_get(t, "$", "string")), lambda t: t.isNotNull()), tax)),
        "language": _variant(language),
        "interaction_pattern": F.when(F.map_contains_key(given, F.lit("interaction_pattern")), _variant(known_pattern(pattern, tax))),
        "metadata": F.to_variant_object(with_keys(metadata, {}, {"source": _variant(F.lit(source)), "coverage": spec, "token_usage": F.to_variant_object(usage)})),
        "generator": F.parse_json(F.to_json(made_by, {"ignoreNullFields": "false"})),
        "code_snippets": F.when(_is(at("code_snippets"), "ARRAY"), _snippets(at("code_snippets"), language, tax)).otherwise(at("code_snippets")),
        "messages": F.when(_is(at("messages"), "ARRAY"), _messages(at("messages"), language, tax)).otherwise(at("messages")),
    }
    defaults = {"id": _variant(record_id), "task_type": _variant(F.col("category")), **{f: _variant(F.col(f)) for f in SPEC_FIELDS}}
    sound = ~F.map_contains_key(given, F.lit("metadata")) | _is(at("metadata"), "OBJECT")
    return F.when(sound, F.to_json(with_keys(given, replaced, defaults)))
