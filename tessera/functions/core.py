"""Column expressions whose meaning is the same as in the records' producers: strip, strict JSON, rounding, seeded draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Without Unicode white space and separators at either end."""
    return F.regexp_replace(col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def not_blank(c) -> Column:
    return F.coalesce(strip(c) != "", F.lit(False))


def strict_json(c) -> Column:
    """Whether the text is one JSON value and nothing else. NaN and repeated keys count as invalid."""
    c = col(c)
    listed = F.size(F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), "$", "array<variant>")) == 1
    keyed = F.concat(F.lit('{"w":'), c, F.lit("}"))
    return F.coalesce(listed & F.try_parse_json(keyed).isNotNull() & (F.size(F.json_object_keys(keyed)) == 1), F.lit(False))


def percent(part, whole) -> Column:
    """100 * part / whole to two places, half to even."""
    return F.bround(col(part).cast("double") / col(whole).cast("double") * 100, 2)


def seeded(seed: int, key) -> Column:
    """A sort key that shuffles rows the same way for the same seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col(key).cast("string")))


def uniform(seed, key) -> Column:
    """In [0, 1), from the seed and the key alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), col(key).cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def choice(values, n) -> Column:
    """values[n mod size]"""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.pmod(col(n), F.lit(len(values))) + 1).cast("int"))


def one_of(c, values) -> Column:
    return col(c).isin(*values) if values else F.lit(False)
