"""JSON out of model replies, and the repair of what they hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.core import col, one_of, strict_json, strip
from tessera.schema import TAXONOMY, Taxonomy


def fenced(text) -> Column:
    """All fenced blocks, stripped, in order."""
    return F.transform(F.regexp_extract_all(col(text), F.lit(r"(?is)```(?:json)?\s*(.*?)```"), 1), lambda x: strip(x))


def _balanced(text: Column, opener: str, closer: str) -> Column:
    """From the first opener to its match, or null; brackets inside strings don't count.

    One pass over the characters that matter: state (depth, in a string, end).
    """
    start = F.instr(text, opener)
    rest = F.substring(text, start, F.length(text))
    # Tokens keep their lengths: an escape inside a string, a quote, a bracket, or a run of anything else.
    tokens = F.regexp_extract_all(rest, F.lit(r'(?s)(\\.|["{}\[\]\\]|[^"{}\[\]\\]+)'), 1)
    zero = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(s: Column, t: Column) -> Column:
        quote = t == '"'
        depth = F.when(s["quoted"], s["depth"]).when(t == opener, s["depth"] + 1).when(t == closer, s["depth"] - 1).otherwise(s["depth"])
        at = s["at"] + F.length(t)
        end = F.when(s["end"] > 0, s["end"]).when(~s["quoted"] & (t == closer) & (depth == 0), at).otherwise(0)
        return F.struct(depth.alias("depth"), F.when(quote, ~s["quoted"]).otherwise(s["quoted"]).alias("quoted"), at.alias("at"), end.alias("end"))

    end = F.aggregate(tokens, zero, step)["end"]
    return F.when((start > 0) & (end > 0), F.substring(rest, F.lit(1), end))


def balanced(text) -> Column:
    """Candidates: the object first, then the array."""
    text = col(text)
    return F.filter(F.array(_balanced(text, "{", "}"), _balanced(text, "[", "]")), lambda x: x.isNotNull())


def first_json(text) -> Column:
    """The first candidate that is JSON: fenced blocks, then balanced ones, then the whole text; else null."""
    candidates = F.concat(fenced(text), balanced(text), F.array(strip(text)))
    return F.try_element_at(F.filter(candidates, lambda c: strict_json(c)), F.lit(1))


def unwrapped(json_text) -> Column:
    """The object under "conversation", if there is one."""
    v = F.try_parse_json(col(json_text))
    inner = F.try_variant_get(v, "$.conversation", "variant")
    return F.when(F.schema_of_variant(inner).startswith("OBJECT"), F.to_json(inner)).otherwise(col(json_text))


def known_tools(tools, tax: Taxonomy = TAXONOMY) -> Column:
    kept = F.filter(col(tools), lambda t: one_of(t, tax.tools))
    return F.when(F.coalesce(F.size(kept), F.lit(0)) > 0, kept).otherwise(F.array(F.lit("shell")))


def known_language(language, tax: Taxonomy = TAXONOMY) -> Column:
    return F.when(one_of(language, tax.languages), col(language)).otherwise(F.lit(tax.languages[0]))


def known_pattern(pattern, tax: Taxonomy = TAXONOMY) -> Column:
    """An unknown pattern becomes null; an empty one stays, and fails validation later."""
    return F.when((col(pattern) == "") | one_of(pattern, tax.interaction_patterns), col(pattern))


def filled(json_text, key: str, default) -> Column:
    """The value of an absent key is the default; an explicit null stays null."""
    v = F.try_parse_json(col(json_text))
    there = F.array_contains(F.json_object_keys(col(json_text)), key)
    return F.when(there, F.try_variant_get(v, f"$.{key}", "string")).otherwise(col(default))
