"""Query name -> plan, and query name -> the same question as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.core import choice
from tessera.operators import attempts, chat, dedup, extract, generate, quality, report, run, split, stats, validate
from tessera.plans import stub
from tessera.schema import FATAL_KEYWORDS, PII, SPEC_FIELDS, TAXONOMY, TURN_BOUNDS
from tessera.sources import jsonl
from tessera.sources.tables import CONVERSATIONS_SQL, conversations, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Rows of generated tables, the similarity of duplicates and matches in these queries.
N, SIMILAR, MATCH = 500, 0.35, 0.2


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# SQL fragments


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _sql(body: str) -> str:
    return f"WITH {CONVERSATIONS_SQL}{body}"


def _pick(values, n: str) -> str:
    return f"([{_quoted(values)}])[1 + ({n}) % {len(values)}]"


def _known(f: str) -> str:
    return f"coalesce(nullif({f}, ''), 'unknown')" if f in ("category", "subcategory", "intent", "learning_stage") else f


def _dist(of: str) -> str:
    """of: a relation of conv_id, field and value."""
    return _sql(
        f", v AS ({of}), t AS (SELECT count(*) AS total FROM conv), c AS (SELECT field, value, count(*) AS count, min(conv_id) AS first FROM v GROUP BY ALL) "
        "SELECT field, value, count, round_even(count::DOUBLE / total::DOUBLE * 100, 2) AS percentage, row_number() OVER (PARTITION BY field ORDER BY count DESC, first, value) AS rank FROM c, t"
    )


def _value(f: str) -> str:
    return f"SELECT conv_id, '{f}' AS field, {_known(f)} AS value FROM conv"


_TOOLS = "SELECT conv_id, 'tools' AS field, unnest(tools) AS value FROM conv"


# Assembly and statistics


@query(_sql(" SELECT conv_id, id, task_type, category, subcategory, intent, difficulty, learning_stage, conversation_length, language, interaction_pattern, array_to_string(tools, ',') AS tools, n AS n_messages, messages[1].role AS first_role FROM conv"))
def conv_assemble(spark, d):
    return conversations(spark, d).select("conv_id", "id", "task_type", *SPEC_FIELDS, "language", "interaction_pattern", F.array_join("tools", ",").alias("tools"), F.size("messages").cast("long").alias("n_messages"), F.col("messages")[0]["role"].alias("first_role"))


@query(_sql(" SELECT conv_id, coalesce(turn_count, n) AS turn_count FROM conv"))
def turn_count_backfill(spark, d):
    return conversations(spark, d).select("conv_id", validate.turn_count().alias("turn_count"))


@query(_dist(_value("category")))
def dist_category(spark, d):
    return stats.distributions(conversations(spark, d), ("category",), tools=None)


@query(_dist(_value("language")))
def dist_language(spark, d):
    return stats.distributions(conversations(spark, d), ("language",), tools=None)


@query(_dist(" UNION ALL ".join([*(_value(f) for f in stats.FIELDS), _TOOLS])))
def dist_all_long(spark, d):
    return stats.distributions(conversations(spark, d))


@query(_dist(" UNION ALL ".join(_value(f) for f in ("category", "subcategory", "intent", "learning_stage"))) + " WHERE value = 'unknown'")
def dist_unknown(spark, d):
    return stats.distributions(conversations(spark, d), ("category", "subcategory", "intent", "learning_stage"), tools=None).where("value = 'unknown'")


@query(_dist(_TOOLS))
def top_skills(spark, d):
    return stats.distributions(conversations(spark, d), ())


@query(
    _sql(
        ", s AS (SELECT n, len(list_filter(messages, lambda m: m.turn = 1)) > 0 AS has, list_sum(list_transform(messages, lambda m: length(m.content))) AS chars FROM conv) "
        "SELECT count(*) AS total_conversations, round_even(sum(n)::DOUBLE / count(*), 2) AS average_turns, round_even(sum(has::INT)::DOUBLE / count(*) * 100, 2) AS code_snippet_coverage, round_even(sum(chars)::DOUBLE / count(*), 2) AS average_characters FROM s"
    )
)
def scalar_stats(spark, d):
    return stats.scalars(conversations(spark, d))


@query("SELECT count(*) AS n_rows, 5 AS n_columns, sum((doc_id IS NULL)::INT + (coalesce(text, '') = '')::INT + (coalesce(lang, '') = '')::INT + (coalesce(source, '') = '')::INT + (n_chars IS NULL)::INT)::BIGINT AS empty_cells FROM documents")
def csv_checks(spark, d):
    return stats.csv_report(table(spark, d, "documents"))


@query("SELECT round_even(avg(toxic) * 100, 2) AS prevalence FROM labels")
def prevalence(spark, d):
    return stats.prevalence(table(spark, d, "labels"), "toxic")


@query(_sql(" SELECT difficulty, min(conv_id) AS conv_id FROM conv GROUP BY 1"))
def examples_per_difficulty(spark, d):
    return report.example_per_difficulty(conversations(spark, d))


# Row generators

_SPECS = f"specs AS (SELECT i AS sample_index, {', '.join(f'{_pick(TAXONOMY.of(f), f"i + {k}")} AS {f}' for k, f in enumerate(SPEC_FIELDS))}, md5('42:' || i) AS shuffle_key FROM range({N}) t(i))"
_UNIFORM = "(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
_PATTERN = "CASE intent WHEN 'ask_for_review' THEN 'review_findings' WHEN 'ask_for_diagnosis' THEN 'multi_turn_debugging' WHEN 'ask_for_implementation' THEN 'implementation_with_tests' WHEN 'ask_for_tests' THEN 'implementation_with_tests' WHEN 'ask_for_explanation' THEN 'design_discussion' ELSE 'single_turn_answer' END"
_TURNS = "CASE conversation_length WHEN 'short' THEN 2 WHEN 'medium' THEN 4 WHEN 'long' THEN 6 ELSE 4 END"


def _drawn(values, seed: str, key: str) -> str:
    return _pick(values, f"floor({_UNIFORM.format(seed=seed, key=key)} * {len(values)})::BIGINT")


@query(f"WITH {_SPECS} SELECT * FROM specs")
def coverage_matrix(spark, d):
    return generate.coverage_matrix(spark, N)


@query(f"WITH {_SPECS}, v AS ({' UNION ALL '.join(f"SELECT '{f}' AS field, {f} AS value FROM specs" for f in SPEC_FIELDS)}), c AS (SELECT field, value, count(*) AS n FROM v GROUP BY ALL) SELECT field, max(n) - min(n) AS spread FROM c GROUP BY 1")
def coverage_balance(spark, d):
    return generate.balance(generate.coverage_matrix(spark, N))


@query(f"WITH {_SPECS} SELECT category, subcategory, count(*) AS n FROM specs GROUP BY ALL")
def coverage_pairs(spark, d):
    return generate.coverage_matrix(spark, N).groupBy("category", "subcategory").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH {_SPECS} SELECT sample_index, 'scenario-' || lpad(sample_index::VARCHAR, 5, '0') || '-' || substr(shuffle_key, 1, 8) AS id, category AS task_type, {', '.join(SPEC_FIELDS)}, "
    f"{_drawn(TAXONOMY.languages, '43', 'sample_index')} AS language, {_TURNS} AS turn_count, {_PATTERN} AS interaction_pattern FROM specs"
)
def scenario_rows(spark, d):
    return generate.scenarios(generate.coverage_matrix(spark, N)).drop("messages")


@query(f"WITH {_SPECS} SELECT intent, {_PATTERN} AS interaction_pattern, count(*) AS n FROM specs GROUP BY ALL")
def interaction_pattern(spark, d):
    return generate.scenarios(generate.coverage_matrix(spark, N)).groupBy("intent", "interaction_pattern").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH {_SPECS}, m AS (SELECT sample_index, subcategory, unnest(range({_TURNS})) AS pos FROM specs) SELECT sample_index, pos, {_pick(('user', 'assistant'), 'pos')} AS role, "
    f"CASE WHEN pos < 2 THEN {_pick(generate.OPENERS, 'pos')} || ' ' || replace(subcategory, '_', ' ') ELSE {_pick(generate.FOLLOW_UPS, 'pos')} END AS content FROM m"
)
def message_template(spark, d):
    return generate.scenarios(generate.coverage_matrix(spark, N)).select("sample_index", F.posexplode("messages").alias("pos", "m")).select("sample_index", F.col("pos").cast("long").alias("pos"), "m.role", "m.content")


@query(
    f"SELECT i AS sample_index, 'conv-' || substr(md5('42:' || i), 1, 12) AS id, {_drawn(TAXONOMY.task_types, '42:t', 'i')} AS task_type, {_drawn(TAXONOMY.difficulties, '42:d', 'i')} AS difficulty, {_drawn(TAXONOMY.languages, '42:l', 'i')} AS language, 4 AS n_messages FROM range({N}) t(i)"
)
def seed_rows(spark, d):
    return generate.seed_conversations(spark, N).select("sample_index", "id", "task_type", "difficulty", "language", F.size("messages").alias("n_messages"))


@query()
def clinical_rows(spark, d):
    return generate.clinical(spark)


# Validation


def _error(when: str, field: str, message: str) -> str:
    return f"CASE WHEN {when} THEN {{'field': {field}, 'message': '{message.replace("'", "''")}'}} END"


def _listed(*parts: str) -> str:
    return "list_filter(" + " || ".join(parts) + ", lambda x: x IS NOT NULL)"


def _errors(of: str) -> str:
    return _sql(f", e AS (SELECT id, {of} AS l FROM conv), k AS (SELECT id, l, unnest(range(1, len(l) + 1)) AS i FROM e) SELECT id, i - 1 AS ord, l[i].field AS field, l[i].message AS message FROM k")


_SCALAR_FIELDS = ("task_type", "category", "subcategory", "intent", "difficulty", "learning_stage", "conversation_length", "language")
_AT = "'messages[' || (i - 1) || '].{}'"
_SCALAR = "[" + ", ".join(_error(f"{f} NOT IN ({_quoted(TAXONOMY.of(f))})", f"'{f}'", f"Unknown {f.replace('_', ' ')}") for f in _SCALAR_FIELDS) + "]"
_ROLE = _error(f"m.role NOT IN ({_quoted(TAXONOMY.roles)})", _AT.format("role"), "Unknown role")
_ROLES = f"list_transform(messages, lambda m, i: {_ROLE})"
_TOOL = "list_transform(tools, lambda t, i: " + _error(f"t NOT IN ({_quoted(TAXONOMY.tools)})", "'tools[' || (i - 1) || ']'", "Unknown tools value") + ")"
_PATTERNS = "[" + _error(f"interaction_pattern NOT IN ({_quoted(TAXONOMY.interaction_patterns)})", "'interaction_pattern'", "Unknown interaction pattern") + "]"
_MESSAGES = f"flatten(list_transform(messages, lambda m, i: [{_ROLE}, {_error('m.turn = 1 AND conv_id % 6 = 5', _AT.format('code_snippets[0].language'), 'Unknown code snippet language')}]))"


def _pii(text: str, field: str) -> str:
    return "[" + ", ".join(_error(f"regexp_matches({text}, '{p.replace('(?iu)', '(?i)').replace('(?U)', '')}')", field, f"Possible PII detected: {name}") for name, p in PII) + "]"


_LENGTHS = "[" + ", ".join(_error(f"conversation_length = '{k}' AND n NOT BETWEEN {a} AND {b}", "'messages'", f"Conversation length '{k}' requires {a}-{b} turns") for k, (a, b) in TURN_BOUNDS.items()) + "]"
_COUNTS = "[" + _error("coalesce(turn_count, n) <> n", "'metadata.turn_count'", "Metadata turn_count must match number of messages") + "]"
_COVERAGE = (
    "["
    + ", ".join(
        _error(when, f"'{prefix}.{f}'", f"{message} must match conversation {f}")
        for prefix, message, odd in (("metadata.coverage", "Coverage metadata", ("intent", "conv_id % 10 = 3")), ("generator.parameters.coverage_matrix", "Generator coverage matrix", ("difficulty", "conv_id % 14 = 6")))
        for f, when in (("category", f"category IS DISTINCT FROM {_pick(TAXONOMY.categories, 'conv_id')}"), odd)
    )
    + "]"
)
_ALL = _listed(_SCALAR, _TOOL, _PATTERNS, _MESSAGES, f"flatten(list_transform(messages, lambda m, i: {_pii('m.content', _AT.format('content'))}))", _LENGTHS, _COUNTS, _COVERAGE)


@query(_errors(_listed(_SCALAR)))
def taxonomy_errors_scalar(spark, d):
    return validate.errors(conversations(spark, d), validate.together(validate.scalar_errors()))


@query(_errors(_listed(_ROLES)))
def role_errors(spark, d):
    return validate.errors(conversations(spark, d), validate.together(validate.role_errors()))


@query(_errors(_listed(_TOOL)))
def tools_errors(spark, d):
    return validate.errors(conversations(spark, d), validate.together(validate.tool_errors()))


@query(_errors(_listed(_LENGTHS)))
def length_band_errors(spark, d):
    return validate.errors(conversations(spark, d), validate.length_errors())


@query(_errors(_listed(_COUNTS)))
def metadata_turncount_errors(spark, d):
    return validate.errors(conversations(spark, d), validate.turn_count_errors())


@query(_errors(_listed(_COVERAGE)))
def coverage_mismatch_errors(spark, d):
    return validate.errors(conversations(spark, d), validate.coverage_errors(generator=True))


@query(_errors(_ALL))
def validation_report(spark, d):
    return validate.errors(conversations(spark, d), validate.all_errors(generator=True))


@query(_errors(_ALL).replace("SELECT id, i - 1 AS ord, l[i].field AS field, l[i].message AS message FROM k", "SELECT l[i].message AS message, count(*) AS n, count(DISTINCT id) AS records FROM k GROUP BY 1"))
def validation_summary(spark, d):
    return validate.errors(conversations(spark, d), validate.all_errors(generator=True)).groupBy("message").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("records"))


@query(_sql(f", e AS (SELECT id, {_listed(_SCALAR, _PATTERNS, _TOOL, _MESSAGES)} AS l FROM conv) SELECT id, array_to_string(list_transform(l, lambda x: x.field), ',') AS fields FROM e WHERE len(l) > 0"))
def taxonomy_report(spark, d):
    return validate.taxonomy_report(conversations(spark, d)).select("id", F.array_join("fields", ",").alias("fields"))


def _pii_sql(name: str, key: str, text: str) -> str:
    return f"WITH e AS (SELECT {key}, {_listed(_pii(text, f"'{text}'"))} AS l FROM {name}) SELECT {key}, unnest(list_transform(l, lambda x: x.field)) AS field, unnest(list_transform(l, lambda x: x.message)) AS message FROM e"


def _pii_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.explode(validate.together(validate.pii_in(text, text))).alias("e")).select(key, "e.field", "e.message")


@query(_pii_sql("documents", "doc_id", "text"))
def pii_documents(spark, d):
    return _pii_rows(table(spark, d, "documents"), "doc_id", "text")


@query(_pii_sql("pages", "page_id", "html"))
def pii_pages(spark, d):
    return _pii_rows(table(spark, d, "pages"), "page_id", "html")


_VALUES = " UNION ALL ".join(f"SELECT conv_id, '{f}' AS field, {f} AS value FROM conv" for f in _SCALAR_FIELDS)


@query(_sql(f", v AS ({_VALUES}) SELECT conv_id, field, value FROM v WHERE value IS NOT NULL AND (field, value) NOT IN (VALUES {', '.join(f"('{f}', '{x}')" for f in _SCALAR_FIELDS for x in TAXONOMY.of(f))})"))
def taxonomy_anti_join(spark, d):
    long = conversations(spark, d).select("conv_id", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in _SCALAR_FIELDS))).alias("x")).select("conv_id", "x.*").where("value IS NOT NULL")
    return long.join(F.broadcast(TAXONOMY.table(spark)), ["field", "value"], "left_anti").select("conv_id", "field", "value")


# Exact dedup


@query("SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1 HAVING count(*) > 1")
def dup_ids(spark, d):
    return dedup.duplicate_ids(table(spark, d, "conversations"), "conv_id")


@query(_sql(" SELECT conv_id, md5(array_to_string(list_transform(messages, lambda m: m.role || ':' || m.content), chr(10))) AS content_hash FROM conv"))
def content_hash(spark, d):
    return conversations(spark, d).select("conv_id", dedup.content_hash().alias("content_hash"))


@query("SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1")
def content_dedup_keep_first(spark, d):
    return dedup.keep_first(table(spark, d, "documents"), F.md5("text"), "doc_id").select("doc_id", "lang", "source")


@query("SELECT doc_id AS duplicate, canonical FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(text)) AS canonical FROM documents WHERE text IS NOT NULL) WHERE doc_id <> canonical")
def content_dup_pairs(spark, d):
    return dedup.duplicate_pairs(table(spark, d, "documents"), F.md5("text"), "doc_id")


_EMBEDDED = ("task_type", "category", "subcategory", "intent", "difficulty", "learning_stage", "language")


@query(_sql(f" SELECT conv_id, array_to_string(list_filter([{', '.join(_EMBEDDED)}] || list_transform(messages, lambda m: m.role || ': ' || m.content) || [CASE WHEN len(list_filter(messages, lambda m: m.turn = 1)) > 0 THEN 'pass' END], lambda x: x IS NOT NULL AND x <> ''), chr(10)) AS embedding_text FROM conv"))
def embedding_text(spark, d):
    return conversations(spark, d).select("conv_id", dedup.embedding_text().alias("embedding_text"))


# Splits


def _split_sql(strata: str, more: str = "") -> str:
    return (
        f"WITH d AS (SELECT doc_id, lang, source, n_chars % 5 AS bucket, md5('42:' || doc_id) AS h, {_UNIFORM.format(seed='42:small', key='doc_id')} AS u FROM documents), "
        f"r AS (SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY h, doc_id) AS r, count(*) OVER (PARTITION BY {strata}) AS n FROM d), "
        "a AS (SELECT *, greatest(1, round_even(n * 0.8::DOUBLE, 0))::BIGINT AS t0, greatest(1, round_even(n * 0.1::DOUBLE, 0))::BIGINT AS v0 FROM r), "
        "b AS (SELECT *, CASE WHEN n - t0 - v0 < 1 THEN CASE WHEN n - v0 - 1 < 0 THEN n - 1 ELSE n - v0 - 1 END ELSE t0 END AS nt, CASE WHEN n - t0 - v0 < 1 AND n - v0 - 1 < 0 THEN 0 ELSE v0 END AS nv FROM a), "
        "s AS (SELECT doc_id, lang, source, CASE WHEN n < 3 THEN CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < 0.9::DOUBLE THEN 'validation' ELSE 'test' END WHEN r <= nt THEN 'train' WHEN r <= nt + nv THEN 'validation' ELSE 'test' END AS split FROM b)" + more
    )


def _split_docs(spark, d, *strata: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", (F.col("n_chars") % 5).alias("bucket"))
    return split.stratified(docs, strata, "doc_id")


@query(_split_sql("lang, source", " SELECT doc_id, split FROM s"))
def stratified_split(spark, d):
    return _split_docs(spark, d, "lang", "source").select("doc_id", "split")


@query(_split_sql("lang, source, bucket", " SELECT doc_id, split FROM s"))
def split_small_strata(spark, d):
    return _split_docs(spark, d, "lang", "source", "bucket").select("doc_id", "split")


@query(_split_sql("lang, source", " SELECT lang, source, split, count(*) AS n FROM s GROUP BY ALL"))
def split_by_stratum_counts(spark, d):
    return _split_docs(spark, d, "lang", "source").groupBy("lang", "source", "split").agg(F.count(F.lit(1)).alias("n"))


@query(_split_sql("lang, source", " SELECT split, count(*) AS n FROM s GROUP BY ALL"))
def split_sizes(spark, d):
    return stats.split_sizes(_split_docs(spark, d, "lang", "source"))


@query(_split_sql("lang, source", ", x AS (SELECT doc_id, split FROM s UNION ALL SELECT doc_id, 'test' FROM documents WHERE doc_id % 50 = 0) SELECT doc_id, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM x GROUP BY 1 HAVING count(DISTINCT split) > 1"))
def leakage_check(spark, d):
    """The split, spoilt on purpose: every fiftieth document is put into the test split again."""
    sound = _split_docs(spark, d, "lang", "source").select("doc_id", "split")
    spoilt = sound.unionByName(table(spark, d, "documents").where("doc_id % 50 = 0").select("doc_id", F.lit("test").alias("split")))
    return split.leaked(spoilt, "doc_id").select("doc_id", F.array_join("splits", ",").alias("splits"))


# JSON Lines. Lines are made from conversations; some are blank, malformed or of another structure.

_BLANK, _BROKEN, _OTHER = "conv_id % 12 = 7", "conv_id >= 12 AND conv_id % 9 = 4", "conv_id >= 12 AND conv_id % 15 = 2"
_BAD = f"NOT ({_BLANK}) AND (({_BROKEN}) OR ({_OTHER}))"


def _lines(spark, d) -> DataFrame:
    record = F.to_json(F.struct("id", "task_type", "category", "difficulty", "language", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.array().cast("array<string>").alias("code_snippets"))).alias("messages"), F.transform("tools", lambda t: t).alias("tools")))
    line = F.when(F.expr(_BLANK), "  ").when(F.expr(_BROKEN), F.concat(record, F.lit(" trailing"))).when(F.expr(_OTHER), '{"id": "odd", "surplus": 1}').otherwise(record)
    return conversations(spark, d).select(F.col("conv_id").alias("ord"), line.alias("line"))


@query(_sql(f" SELECT conv_id AS ord, id, n AS n_messages FROM conv WHERE NOT ({_BLANK}) AND NOT ({_BAD})"))
def jsonl_tolerant(spark, d):
    return jsonl.parsed(jsonl.tolerant(_lines(spark, d))).select("ord", "record.id", F.size("record.messages").cast("long").alias("n_messages"))


@query(_sql(f" SELECT count_if(NOT ({_BLANK}) AND NOT ({_BAD})) AS loaded, count_if({_BAD}) AS skipped FROM conv"))
def jsonl_skipped(spark, d):
    return jsonl.skipped(_lines(spark, d))


_PREFIX = f"conv_id < coalesce((SELECT min(conv_id) FROM conv WHERE {_BAD}), 9223372036854775807)"


@query(_sql(f" SELECT conv_id AS ord FROM conv WHERE NOT ({_BLANK}) AND {_PREFIX}"))
def valid_prefix(spark, d):
    return jsonl.valid_prefix(_lines(spark, d)).select("ord")


@query(_sql(f" SELECT conv_id AS ord FROM conv WHERE NOT ({_BLANK}) AND {_PREFIX} ORDER BY conv_id LIMIT 10"))
def prefix_limit(spark, d):
    return jsonl.prefix_limit(_lines(spark, d), 10).select("ord")


@query(_sql(f" SELECT conv_id AS ord FROM conv WHERE NOT ({_BLANK}) AND NOT ({_BAD}) ORDER BY conv_id LIMIT 20"))
def example_head(spark, d):
    return jsonl.examples(_lines(spark, d)).select("ord")


#: (line, paths of its structural errors)
_SHAPES = (
    ('{"id": "a", "task_type": "t", "difficulty": "easy", "language": "go", "messages": [{"role": "user", "content": "x"}]}', ()),
    ('{"id": "a", "task_type": "t", "difficulty": "easy", "language": "go"}', ("messages",)),
    ('{"id": "", "task_type": 5, "difficulty": "easy", "language": "go", "messages": [], "more": 1}', ("id", "task_type", "messages", "more")),
    ('{"id": "a", "task_type": "t", "difficulty": " ", "language": "go", "messages": [{"role": 4, "content": " "}, "x", {"role": "user", "content": "y", "k": 1}]}', ("messages[0].role", "messages[0].content", "messages[1]", "messages[2].k")),
    ('{"id": "a", "task_type": "t", "difficulty": "easy", "language": "go", "messages": [{"role": "user", "content": "x", "code_snippets": [{"language": "go", "code": "", "size": 3}]}], "code_snippets": null}', ("messages[0].code_snippets[0].code", "messages[0].code_snippets[0].size", "code_snippets")),
    ('{"id": "a", "task_type": "t", "difficulty": "easy", "language": "go", "messages": [{"role": "user", "content": "x"}], "tools": ["git", 7], "metadata": {"turn_count": 4.5, "quality_score": 2, "own": 1}, "generator": 3}', ("tools[1]", "metadata.turn_count", "metadata.quality_score", "generator")),
    ('{"id": "a", "task_type": "t", "difficulty": "easy", "language": "go", "messages": [{"role": "user", "content": "x"}], "metadata": {"turn_count": "4"}, "category": null, "intent": 1}', ("intent",)),
)


@query(
    f"WITH s AS (SELECT conv_id, ([{', '.join('[' + _quoted(x[1]) + ']' if x[1] else '[]::VARCHAR[]' for x in _SHAPES)}])[1 + conv_id % {len(_SHAPES)}] AS l FROM (SELECT DISTINCT conv_id FROM conversations)) SELECT conv_id, unnest(l) AS field FROM s"
)
def structural_errors(spark, d):
    ids = table(spark, d, "conversations").select("conv_id").distinct()
    lines = ids.select("conv_id", choice([x[0] for x in _SHAPES], F.col("conv_id")).alias("line"))
    return validate.with_structure(lines).select("conv_id", F.explode("structure").alias("e")).select("conv_id", "e.field")


@query("SELECT conv_id, CASE conv_id % 3 WHEN 0 THEN '<missing>' WHEN 1 THEN 'None' ELSE conv_id::VARCHAR END AS record_id FROM (SELECT DISTINCT conv_id FROM conversations)")
def record_ids(spark, d):
    i = F.col("conv_id")
    line = F.when(i % 3 == 0, F.lit("{}")).when(i % 3 == 1, F.lit('{"id": null}')).otherwise(F.concat(F.lit('{"id": "'), i.cast("string"), F.lit('"}')))
    return table(spark, d, "conversations").select("conv_id").distinct().select("conv_id", validate.record_id(line).alias("record_id"))


# Similarity

_PAIRS = "pr AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id), p AS (SELECT a, b, round(s, 6) AS similarity FROM pr WHERE s >= {})"
_GREEDY = (
    f"WITH RECURSIVE {_PAIRS.format(SIMILAR)}, o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS i FROM embeddings), nb AS (SELECT o.i, o.vec_id, coalesce(list(p.a) FILTER (p.a IS NOT NULL), []) AS l FROM o LEFT JOIN p ON p.b = o.vec_id GROUP BY ALL), "
    "r(i, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT nb.i, CASE WHEN len(list_intersect(nb.l, r.kept)) > 0 THEN r.kept ELSE list_append(r.kept, nb.vec_id) END FROM r JOIN nb ON nb.i = r.i + 1), "
    "k AS (SELECT unnest(kept) AS vec_id FROM r WHERE i = (SELECT max(i) FROM o))"
)


@query(f"WITH {_PAIRS.format(SIMILAR)} SELECT * FROM p")
def cosine_pairs(spark, d):
    return dedup.similar_pairs(table(spark, d, "embeddings"), SIMILAR)


def _greedy(spark, d) -> tuple[DataFrame, DataFrame]:
    return dedup.greedy(table(spark, d, "embeddings"), SIMILAR)


@query(_GREEDY + " SELECT vec_id FROM k")
def semantic_dedup_kept(spark, d):
    return _greedy(spark, d)[0]


@query(_GREEDY + " SELECT b AS duplicate, a AS canonical, similarity FROM p WHERE a IN (SELECT vec_id FROM k) AND b NOT IN (SELECT vec_id FROM k) QUALIFY row_number() OVER (PARTITION BY b ORDER BY similarity DESC, a) = 1")
def semantic_dup_matches(spark, d):
    return _greedy(spark, d)[1]


@query(
    f"WITH s AS (SELECT a.vec_id AS candidate, b.vec_id AS canonical, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0) "
    f"SELECT candidate, canonical, round(s, 6) AS similarity FROM s WHERE s >= {MATCH} QUALIFY row_number() OVER (PARTITION BY candidate ORDER BY round(s, 6) DESC, canonical) = 1"
)
def best_match_lookup(spark, d):
    vectors = table(spark, d, "embeddings")
    return dedup.best_match(vectors.where("vec_id % 50 = 0"), vectors, MATCH)


# Extraction. Replies are made from documents: fenced, embedded, an array, or without JSON.

_REPLY = """CASE doc_id % 4 WHEN 0 THEN 'Sure:' || chr(10) || '```json' || chr(10) || '{"id": ' || doc_id || '}' || chr(10) || '```' || chr(10) || 'and ```JSON {"b": 2} ``` too'
 WHEN 1 THEN 'see {"q": "a } b", "id": ' || doc_id || '} there' WHEN 2 THEN 'list [{"id": ' || doc_id || '}, 2] end' ELSE 'no JSON { here' END"""


def _replies(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.expr(_REPLY.replace("chr(10)", "char(10)")).alias("reply"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 0 END AS n_blocks, CASE WHEN doc_id % 4 = 0 THEN '{\"id\": ' || doc_id || '}' END AS first_block FROM documents")
def fenced_json(spark, d):
    blocks = extract.fenced("reply")
    return _replies(spark, d).select("doc_id", F.size(blocks).alias("n_blocks"), F.try_element_at(blocks, F.lit(1)).alias("first_block"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '{"id": ' || doc_id || '}' WHEN 1 THEN '{"q": "a } b", "id": ' || doc_id || '}' WHEN 2 THEN '{"id": ' || doc_id || '}' END AS json FROM documents""")
def balanced_json(spark, d):
    return _replies(spark, d).select("doc_id", extract.first_json("reply").alias("json"))


@query("SELECT doc_id, CASE doc_id % 2 WHEN 0 THEN '{\"id\":' || doc_id || '}' ELSE '{\"conversation\": 5}' END AS json FROM documents")
def unwrap_payload(spark, d):
    i = F.col("doc_id")
    text = F.when(i % 2 == 0, F.concat(F.lit('{"conversation": {"id": '), i.cast("string"), F.lit("}}"))).otherwise('{"conversation": 5}')
    return table(spark, d, "documents").select("doc_id", extract.unwrapped(text).alias("json"))


_KNOWN_TOOLS = f"list_filter(tools, lambda t: t IN ({_quoted(TAXONOMY.tools)}))"


@query(_sql(f" SELECT conv_id, CASE WHEN len({_KNOWN_TOOLS}) > 0 THEN array_to_string({_KNOWN_TOOLS}, ',') ELSE 'shell' END AS tools, CASE WHEN conv_id % 6 = 5 THEN 'python' ELSE {_pick((*TAXONOMY.languages, 'brainfuck'), 'conv_id')} END AS language, CASE WHEN interaction_pattern IN ({_quoted(TAXONOMY.interaction_patterns)}) THEN interaction_pattern END AS interaction_pattern FROM conv"))
def payload_sanitize(spark, d):
    df = conversations(spark, d).withColumn("language", choice((*TAXONOMY.languages, "brainfuck"), F.col("conv_id")))
    return df.select("conv_id", F.array_join(extract.known_tools("tools"), ",").alias("tools"), extract.known_language(F.col("language")).alias("language"), extract.known_pattern(F.col("interaction_pattern")).alias("interaction_pattern"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'given' WHEN 1 THEN NULL ELSE 'default' END AS intent FROM documents")
def default_fill(spark, d):
    text = choice(('{"intent": "given"}', '{"intent": null}', '{"other": 1}'), F.col("doc_id"))
    return table(spark, d, "documents").select("doc_id", extract.filled(text, "intent", F.lit("default")).alias("intent"))


# Quality


def _score_sql(name: str) -> str:
    drawn = f"('0x' || substr(md5(doc_id || ':{name}'), 1, 6))::BIGINT"
    return f"CASE WHEN quality = 1 THEN 7 + {drawn} % 4 ELSE 1 + {drawn} % 10 END"


def _scored(spark, d) -> DataFrame:
    def score(name: str) -> Column:
        drawn = F.conv(F.substring(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(f":{name}"))), 1, 6), 16, 10).cast("long")
        return F.when(F.col("quality") == 1, 7 + drawn % 4).otherwise(1 + drawn % 10).cast("int")

    dims = F.array(*(F.struct(F.lit(k).alias("name"), score(k).alias("score"), F.lit("because").alias("reasoning")) for k in quality.QUALITY_WEIGHTS))
    return quality.judged(table(spark, d, "labels").select("doc_id", dims.alias("dimensions")))


_RAW = "0.0::DOUBLE + " + " + ".join(f"{w}::DOUBLE * ((({_score_sql(k)}) - 1) / 9.0::DOUBLE)" for k, w in quality.QUALITY_WEIGHTS.items())
_JUDGED = f"WITH j AS (SELECT doc_id, {_RAW} AS raw FROM labels)"


@query(f"{_JUDGED} SELECT doc_id, round_even(raw, 4) AS overall_score, raw >= 0.7::DOUBLE AS passed FROM j")
def quality_overall(spark, d):
    return _scored(spark, d).select("doc_id", "overall_score", "passed")


@query(f"{_JUDGED} SELECT doc_id FROM j WHERE raw >= 0.7::DOUBLE")
def quality_gate(spark, d):
    return _scored(spark, d).where("passed").select("doc_id")


@query(f"{_JUDGED} SELECT count(*) AS total, count_if(raw >= 0.7::DOUBLE) AS passed, count_if(NOT raw >= 0.7::DOUBLE) AS failed FROM j")
def quality_tally(spark, d):
    return quality.tally(_scored(spark, d))


_DIM = '{{"name": "{}", "score": {}, "reasoning": "{}"}}'
_GOOD = [_DIM.format(k, 8, "fine") for k in quality.QUALITY_WEIGHTS]
_FIRST, _SECOND = list(quality.QUALITY_WEIGHTS)[:2]
#: (judge's payload, what is wrong with it)
_PAYLOADS = (
    ('{"dimensions": [' + ", ".join(_GOOD) + "]}", None),
    ('["x"]', "not an object"),
    ('{"dimensions": 4}', "dimensions is not a list"),
    ('{"dimensions": [' + ", ".join(_GOOD[1:]) + "]}", f"missing: {_FIRST}"),
    ('{"dimensions": [' + ", ".join([*_GOOD, _GOOD[0]]) + "]}", "duplicate dimension"),
    ('{"dimensions": [' + ", ".join([_DIM.format(_FIRST, 11, "x"), *_GOOD[1:]]) + "]}", "score out of range"),
    ('{"dimensions": [' + ", ".join([_DIM.format(_FIRST, 10.9, "x"), _DIM.format(_SECOND, 1, " "), *_GOOD[2:]]) + "]}", "blank reasoning"),
    ('{"dimensions": [' + ", ".join([*_GOOD, _DIM.format("style", 5, "x")]) + "]}", "unknown dimension"),
)


@query(f"SELECT doc_id, ([{', '.join(_quoted([x[1]]) if x[1] else 'NULL' for x in _PAYLOADS)}])[1 + doc_id % {len(_PAYLOADS)}] AS problem FROM labels")
def payload_problems(spark, d):
    return table(spark, d, "labels").select("doc_id", quality.payload_problem(choice([x[0] for x in _PAYLOADS], F.col("doc_id"))).alias("problem"))


# Attempts. Sample s succeeds at attempt s mod 4 + 1, if it has so many; an event is an attempt.

_ATTEMPT = "SELECT event_id // 3 AS sample_index, event_id % 3 + 1 AS attempt, event_id FROM events"
_ATTEMPTS = f"a AS (SELECT sample_index, attempt, CASE WHEN attempt = sample_index % 4 + 1 THEN NULL ELSE {_pick(attempts.REASONS, 'event_id')} END AS reason, (event_id % 7) / 2.0::DOUBLE AS seconds FROM ({_ATTEMPT}) WHERE attempt <= sample_index % 4 + 1)"


def _attempts(spark, d) -> DataFrame:
    e = table(spark, d, "events").select(F.floor(F.col("event_id") / 3).alias("sample_index"), (F.col("event_id") % 3 + 1).alias("attempt"), "event_id")
    won = F.col("sample_index") % 4 + 1
    return e.where(F.col("attempt") <= won).select("sample_index", "attempt", F.when(F.col("attempt") != won, choice(attempts.REASONS, F.col("event_id"))).alias("reason"), ((F.col("event_id") % 7) / 2.0).alias("seconds"))


@query(f"WITH {_ATTEMPTS} SELECT reason, count(*) AS n FROM a WHERE reason IS NOT NULL GROUP BY 1")
def reject_reasons(spark, d):
    return attempts.reasons(_attempts(spark, d))


@query(f"WITH {_SPECS}, {_ATTEMPTS} SELECT sample_index, category, intent FROM specs WHERE sample_index NOT IN (SELECT sample_index FROM a WHERE reason IS NULL)")
def resume_missing(spark, d):
    return attempts.missing(generate.coverage_matrix(spark, N), _attempts(spark, d).where("reason IS NULL")).select("sample_index", "category", "intent")


@query(
    f"WITH {_ATTEMPTS}, s AS (SELECT sample_index, max(attempt) FILTER (reason IS NULL) AS won, sum(seconds) FILTER (reason IS NULL) AS seconds, count(reason) AS rejected, count_if(reason = 'api_error') AS api FROM a GROUP BY 1) "
    "SELECT count(*) AS requested, count(won) AS generated, count(*) - count(won) AS skipped, coalesce(sum(won - 1), 0)::BIGINT AS retries, coalesce(sum(rejected), 0)::BIGINT AS rejected_attempts, coalesce(sum(api), 0)::BIGINT AS api_errors, round_even(sum(seconds) / count(won), 2) AS average_seconds FROM s"
)
def run_metrics(spark, d):
    return attempts.run_metrics(_attempts(spark, d))


@query("SELECT coalesce(sum(p), 0)::BIGINT AS prompt_tokens, coalesce(sum(c), 0)::BIGINT AS completion_tokens, coalesce(sum(p + c), 0)::BIGINT AS total_tokens, count(*) AS requests FROM (SELECT CASE WHEN event_id % 5 > 0 THEN event_id % 100 END AS p, CASE WHEN event_id % 5 > 0 THEN event_id % 37 END AS c FROM events)")
def token_usage(spark, d):
    p, c = (F.when(F.col("event_id") % 5 > 0, F.col("event_id") % n) for n in (100, 37))
    return attempts.token_usage(table(spark, d, "events").select(p.alias("prompt_tokens"), c.alias("completion_tokens"), (p + c).alias("total_tokens")))


_ERRORS = ("Quota exceeded today", "timeout", "INVALID API KEY given", "connection reset", "billing problem")


@query(f"SELECT event_id, {' OR '.join(f"contains(lower(m), '{k}')" for k in FATAL_KEYWORDS)} AS fatal FROM (SELECT event_id, {_pick(_ERRORS, 'event_id')} AS m FROM events)")
def fatal_errors(spark, d):
    return table(spark, d, "events").select("event_id", validate.fatal(choice(_ERRORS, F.col("event_id"))).alias("fatal"))


# Prompts, embeddings and the generation run, with a model whose answers follow from the prompt.


@query(_sql(" SELECT conv_id, '<' || id || '|' || coalesce(nullif(task_type, ''), category, '') || '|' || coalesce(nullif(category, ''), task_type) || '|' || array_to_string(tools, ', ') || '|' || coalesce(turn_count::VARCHAR, '') || '|{}>' AS prompt FROM conv"))
def prompt_texts(spark, d):
    return chat.prompts(conversations(spark, d), "<{id}|{task_type}|{category}|{tools}|{turn_count}|{{}}>").select("conv_id", "prompt")


@query("SELECT doc_id, length(coalesce(text, ''))::DOUBLE AS n, (length(coalesce(text, '')) - length(replace(coalesce(text, ''), 'e', '')))::DOUBLE AS e FROM documents")
def embedded_texts(spark, d):
    encoder = lambda: lambda texts: [(len(t), t.count("e")) for t in texts]
    rows = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return dedup.embed(rows, encoder, "text", keep=["doc_id"]).select("doc_id", F.col("embedding")[0].alias("n"), F.col("embedding")[1].alias("e"))


_OUTCOMES = {stub.API_ERROR: "api_error", stub.NO_JSON: "generation_error", stub.PERSONAL: "validation_failed", stub.COPY: "duplicate", stub.SHALLOW: "quality_failed", stub.UNEXPECTED: "unexpected_error"}
_RUN_ATTEMPTS = 3
#: The first sample's first attempt is the one that others copy.
_RUN = (
    f"k AS (SELECT sample_index, attempt, (7 * sample_index + 3 * attempt) % {stub.KINDS} AS kind FROM range((SELECT count(DISTINCT conv_id) FROM conversations)) s(sample_index), range(1, {_RUN_ATTEMPTS + 1}) a(attempt)), "
    f"o AS (SELECT *, CASE WHEN sample_index = 0 AND kind = {stub.COPY} THEN NULL {' '.join(f"WHEN kind = {k} THEN '{v}'" for k, v in _OUTCOMES.items())} END AS reason FROM k), "
    f"a AS (SELECT sample_index, attempt, kind, reason FROM (SELECT *, min(CASE WHEN reason IS NULL THEN attempt END) OVER (PARTITION BY sample_index) AS won FROM o) WHERE attempt <= coalesce(won, {_RUN_ATTEMPTS}))"
)


def _run(spark, d, existing=None) -> DataFrame:
    n = table(spark, d, "conversations").select("conv_id").where("conv_id IS NOT NULL").distinct().count()
    made = run.Run(stub.client, stub.TEMPLATE, stub.encoder, stub.judge, stub.JUDGE_TEMPLATE, max_attempts=_RUN_ATTEMPTS, options={"max_retries": 0, "parse_retries": 0, "seed": 7})
    good, bad = made(generate.scenarios(generate.coverage_matrix(spark, n)), existing)
    return good.unionByName(bad)


@query(f"WITH {_RUN} SELECT sample_index, attempt, reason FROM a")
def generation_run(spark, d):
    return _run(spark, d).select("sample_index", F.col("attempt").cast("long").alias("attempt"), "reason")


@query(f"WITH {_RUN} SELECT sample_index, 'git' AS tools, 'go' AS language, sample_index AS rating, sample_index AS made_for, 7 AS seed, 15 AS tokens FROM a WHERE reason IS NULL")
def generated_records(spark, d):
    """What the accepted records hold: repaired values, keys of the reply's own, metadata and generator."""
    at = lambda path: F.get_json_object("json", path)
    rows = _run(spark, d).where("reason IS NULL")
    return rows.select(
        "sample_index", F.array_join(F.from_json(at("$.tools"), "array<string>"), ",").alias("tools"), at("$.language").alias("language"), at("$.metadata.rating").cast("long").alias("rating"),
        at("$.generator.parameters.sample_index").cast("long").alias("made_for"), at("$.generator.seed").cast("int").alias("seed"), at("$.metadata.token_usage.total_tokens").cast("int").alias("tokens"),
    )
