"""Validation as an error relation: structure, taxonomy, personal data, lengths, metadata.

Each check is an expression array<struct<field, message>> over one row, so all checks run in one stage
without a shuffle; errors() explodes them in the order of the checks.
"""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.core import col, not_blank, one_of
from tessera.schema import FATAL_KEYWORDS, PII, SPEC_FIELDS, TAXONOMY, TOP_KEYS, TURN_BOUNDS, Taxonomy

ERRORS = "array<struct<field: string, message: string>>"


def error(condition: Column, field, message: str) -> Column:
    field = F.lit(field) if isinstance(field, str) else field
    return F.when(F.coalesce(condition, F.lit(False)), F.struct(field.alias("field"), F.lit(message).alias("message")))


def _or_none(errors: Column) -> Column:
    """A null array, of a null list, has no errors."""
    return F.coalesce(errors.cast(ERRORS), F.array().cast(ERRORS))


def together(*parts: Column) -> Column:
    """Of arrays of errors, without nulls; a null array, of a null list, has none."""
    return F.filter(F.concat(*map(_or_none, parts)), lambda x: x.isNotNull())


def scalar_errors(tax: Taxonomy = TAXONOMY) -> Column:
    fields = ("task_type", "category", "subcategory", "intent", "difficulty", "learning_stage", "conversation_length", "language")
    return F.array(*(error(~one_of(f, tax.of(f)), f, f"Unknown {f.replace('_', ' ')}") for f in fields))


def tool_errors(tax: Taxonomy = TAXONOMY) -> Column:
    return F.transform("tools", lambda t, i: error(~one_of(t, tax.tools), F.concat(F.lit("tools["), i.cast("string"), F.lit("]")), "Unknown tools value"))


def pattern_errors(tax: Taxonomy = TAXONOMY) -> Column:
    return F.array(error(~one_of("interaction_pattern", tax.interaction_patterns), "interaction_pattern", "Unknown interaction pattern"))


def snippet_errors(snippets, prefix: Column, tax: Taxonomy = TAXONOMY) -> Column:
    return F.transform(snippets, lambda s, j: error(~one_of(s["language"], tax.languages), F.concat(prefix, F.lit("code_snippets["), j.cast("string"), F.lit("].language")), "Unknown code snippet language"))


def at_message(i: Column, rest: str) -> Column:
    return F.concat(F.lit("messages["), i.cast("string"), F.lit("]." + rest))


def message_errors(tax: Taxonomy = TAXONOMY) -> Column:
    return F.flatten(F.transform("messages", lambda m, i: F.concat(F.array(error(~one_of(m["role"], tax.roles), at_message(i, "role"), "Unknown role")), _or_none(snippet_errors(m["code_snippets"], at_message(i, ""), tax)))))


def role_errors(tax: Taxonomy = TAXONOMY) -> Column:
    return F.transform("messages", lambda m, i: error(~one_of(m["role"], tax.roles), at_message(i, "role"), "Unknown role"))


def taxonomy_errors(tax: Taxonomy = TAXONOMY) -> Column:
    return together(scalar_errors(tax), snippet_errors("code_snippets", F.lit(""), tax), tool_errors(tax), pattern_errors(tax), message_errors(tax))


def taxonomy_paths(tax: Taxonomy = TAXONOMY) -> Column:
    """The fields alone; here the interaction pattern comes before the tools."""
    return F.transform(together(scalar_errors(tax), snippet_errors("code_snippets", F.lit(""), tax), pattern_errors(tax), tool_errors(tax), message_errors(tax)), lambda e: e["field"])


def taxonomy_report(df: DataFrame, tax: Taxonomy = TAXONOMY, order="conv_id") -> DataFrame:
    """id, fields of records with errors; of records that share an id the last counts."""
    last = df.select("id", F.col(order).alias("ord"), taxonomy_paths(tax).alias("fields")).groupBy("id").agg(F.max_by("fields", "ord").alias("fields"))
    return last.where(F.size("fields") > 0)


def pii_in(text, field: Column | str) -> Column:
    return F.array(*(error(col(text).rlike(p), field, f"Possible PII detected: {name}") for name, p in PII))


def pii_errors() -> Column:
    """Message contents and their snippets' code, then the record's snippets' code."""
    code = lambda s, j, prefix: pii_in(s["code"], F.concat(prefix, F.lit("code_snippets["), j.cast("string"), F.lit("].code")))
    inside = F.transform("messages", lambda m, i: F.concat(pii_in(m["content"], at_message(i, "content")), _or_none(F.flatten(F.transform(m["code_snippets"], lambda s, j: code(s, j, at_message(i, "")))))))
    return together(F.flatten(inside), F.flatten(F.transform("code_snippets", lambda s, j: code(s, j, F.lit("")))))


def length_errors() -> Column:
    n = F.size("messages")
    return together(F.array(*(error((F.col("conversation_length") == k) & ~n.between(low, high), "messages", f"Conversation length '{k}' requires {low}-{high} turns") for k, (low, high) in TURN_BOUNDS.items())))


def turn_count() -> Column:
    """Null is filled with the number of messages."""
    return F.coalesce(F.col("metadata.turn_count"), F.size("messages").cast("long"))


def turn_count_errors() -> Column:
    return together(F.array(error(turn_count() != F.size("messages"), "metadata.turn_count", "Metadata turn_count must match number of messages")))


def _mismatches(given: Column, prefix: str, message: str) -> Column:
    """Only keys that are there count; a null value is a mismatch with any other."""
    return F.array(*(error(F.map_contains_key(given, F.lit(f)) & ~F.try_element_at(given, F.lit(f)).eqNullSafe(F.col(f)), f"{prefix}.{f}", message + f) for f in SPEC_FIELDS))


def coverage_errors(generator: bool = False) -> Column:
    out = [_mismatches(F.col("metadata.coverage"), "metadata.coverage", "Coverage metadata must match conversation ")]
    if generator:
        out.append(_mismatches(F.col("generator.parameters.coverage_matrix"), "generator.parameters.coverage_matrix", "Generator coverage matrix must match conversation "))
    return together(*out)


def all_errors(tax: Taxonomy = TAXONOMY, generator: bool = False) -> Column:
    return F.concat(taxonomy_errors(tax), pii_errors(), length_errors(), turn_count_errors(), coverage_errors(generator))


def errors(df: DataFrame, of: Column, key: str = "id") -> DataFrame:
    """key, ord, field, message."""
    return df.select(F.col(key), F.posexplode(of).alias("ord", "e")).select(key, "ord", "e.field", "e.message")


# Structure, over raw JSON lines


def _get(v, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


_TYPES = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "VOID": "null", "BOOLEAN": "boolean", **dict.fromkeys(("TINYINT", "SMALLINT", "INT", "BIGINT"), "int")}


def _type(v) -> Column:
    """object, array, string, int, number, boolean or null of a variant; null if it is absent."""
    known = F.create_map(*(F.lit(x) for kv in _TYPES.items() for x in kv))
    return F.when(v.isNotNull(), F.coalesce(F.try_element_at(known, F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)), F.lit("number")))


def _keys(v) -> Column:
    return F.coalesce(F.json_object_keys(F.to_json(v)), F.array().cast("array<string>"))


def _extra(v, known, prefix: Column) -> Column:
    return F.transform(F.array_except(_keys(v), F.array(*(F.lit(k) for k in known))), lambda k: error(F.lit(True), F.concat(prefix, k), "Extra inputs are not permitted"))


def _text(v, key: str, path: Column, required: bool, blank_ok: bool = False) -> Column:
    t, s = _type(_get(v, f"$.{key}")), _get(v, f"$.{key}", "string")
    if not required:
        return F.array(error(~t.isin("string", "null"), path, "Input should be a valid string"))
    bad = (s == "") if blank_ok else ~not_blank(s)
    return F.array(error(t.isNull(), path, "Field required"), error(t != "string", path, "Input should be a valid string"), error((t == "string") & bad, path, "String should not be empty"))


def _snippets(v, prefix: Column) -> Column:
    """Errors of the array code_snippets of v."""
    array, at = _get(v, "$.code_snippets", "array<variant>"), F.concat(prefix, F.lit("code_snippets"))
    t = _type(_get(v, "$.code_snippets"))

    def one(s, j):
        p = F.concat(at, F.lit("["), j.cast("string"), F.lit("]"))
        dot = lambda k: F.concat(p, F.lit("." + k))
        inner = F.concat(*(_text(s, k, dot(k), k in ("language", "code")) for k in ("language", "code", "filename", "purpose")), _extra(s, ("language", "code", "filename", "purpose"), F.concat(p, F.lit("."))))
        return F.when(_type(s) == "object", inner).otherwise(F.array(error(F.lit(True), p, "Input should be an object")))

    return F.concat(F.array(error(t.isNotNull() & (t != "array"), at, "Input should be a valid list")), F.coalesce(F.flatten(F.transform(array, one)), F.array().cast(ERRORS)))


def _messages(v) -> Column:
    t, array = _type(_get(v, "$.messages")), _get(v, "$.messages", "array<variant>")

    def one(m, i):
        p = F.concat(F.lit("messages["), i.cast("string"), F.lit("]"))
        dot = lambda k: F.concat(p, F.lit("." + k))
        inner = F.concat(_text(m, "role", dot("role"), True), _text(m, "content", dot("content"), True), _snippets(m, F.concat(p, F.lit("."))), _extra(m, ("role", "content", "code_snippets"), F.concat(p, F.lit("."))))
        return F.when(_type(m) == "object", inner).otherwise(F.array(error(F.lit(True), p, "Input should be an object")))

    first = F.array(error(t.isNull(), "messages", "Field required"), error(t != "array", "messages", "Input should be a valid list"), error(F.size(array) == 0, "messages", "List should have at least 1 item"))
    return F.concat(first, F.coalesce(F.flatten(F.transform(array, one)), F.array().cast(ERRORS)))


def _metadata(v) -> Column:
    m = _get(v, "$.metadata")
    t = lambda k: _type(_get(m, f"$.{k}"))
    n = F.coalesce(_get(m, "$.turn_count", "double"), F.lit(0.0))
    whole = (t("turn_count") == "int") | (t("turn_count").isin("number", "string") & (n == F.floor(n)))
    q = F.coalesce(_get(m, "$.quality_score", "double"), F.lit(-1.0))
    inner = F.array(
        error(t("source").isNotNull() & (t("source") != "string"), "metadata.source", "Input should be a valid string"),
        error(t("turn_count").isNotNull() & (t("turn_count") != "null") & ~(whole & (n >= 1)), "metadata.turn_count", "Input should be an integer of at least 1"),
        error(t("tags").isNotNull() & (t("tags") != "array"), "metadata.tags", "Input should be a valid list"),
        error(t("quality_score").isNotNull() & (t("quality_score") != "null") & ~q.between(0, 1), "metadata.quality_score", "Input should be between 0 and 1"),
    )
    return F.when(_type(m) == "object", inner).otherwise(F.array(error(_type(m).isNotNull(), "metadata", "Input should be an object")))


def _generator(v) -> Column:
    g = _get(v, "$.generator")
    seed, params = _type(_get(g, "$.seed")), _type(_get(g, "$.parameters"))
    inner = F.concat(
        _text(g, "name", F.lit("generator.name"), True, True), _text(g, "version", F.lit("generator.version"), True, True),
        F.array(error(~seed.isin("int", "null"), "generator.seed", "Input should be an integer"), error(params != "object", "generator.parameters", "Input should be an object")),
    )
    return F.when(_type(g) == "object", inner).otherwise(F.array(error(~_type(g).isin("null", "object"), "generator", "Input should be an object")))


def parsed_once(df: DataFrame, line: str, out: str) -> DataFrame:
    """df with the line as a variant. It comes out of a generator, so that no rule copies the parsing into what reads it."""
    return df.select("*", F.explode(F.array(F.try_parse_json(line))).alias(out))


def with_structure(df: DataFrame, line: str = "line", out: str = "structure") -> DataFrame:
    """df with the structural errors of the line; null for no line."""
    return parsed_once(df, line, _PARSED).withColumn(out, F.when(F.col(line).isNotNull(), structural_errors())).drop(_PARSED)


_PARSED = "__parsed"


@cache
def structural_errors() -> Column:
    """All structural errors of the variant in column _PARSED, a line that is strict JSON, with their paths.

    It is built once: its thousands of parts take seconds to make, each by a call to the JVM.
    """
    v = F.col(_PARSED)
    tools, t = _get(v, "$.tools", "array<variant>"), _type(_get(v, "$.tools"))
    required = ("id", "task_type", "difficulty", "language")
    optional = ("category", "subcategory", "intent", "learning_stage", "conversation_length", "interaction_pattern")
    parts = [
        *(_text(v, k, F.lit(k), True, True) for k in required), *(_text(v, k, F.lit(k), False) for k in optional), _messages(v), _snippets(v, F.lit("")),
        F.array(error(t.isNotNull() & (t != "array"), "tools", "Input should be a valid list")),
        F.coalesce(F.transform(tools, lambda x, i: error(_type(x) != "string", F.concat(F.lit("tools["), i.cast("string"), F.lit("]")), "Input should be a valid string")), F.array().cast(ERRORS)),
        _metadata(v), _generator(v), _extra(v, TOP_KEYS, F.lit("")),
    ]
    return F.when(_type(v) == "object", together(*parts)).otherwise(F.array(F.struct(F.lit("").alias("field"), F.lit("Input should be an object").alias("message"))))


def record_id(line) -> Column:
    """The id as text; a missing one and an explicit null have names of their own."""
    v = F.try_parse_json(col(line))
    at = _get(v, "$.id")
    return F.when(at.isNull(), "<missing>").when(_type(at) == "null", "None").otherwise(_get(v, "$.id", "string"))


def fatal(message) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(F.lower(col(message)), F.lit(k)) for k in FATAL_KEYWORDS))
