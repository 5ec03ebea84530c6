"""Model-made conversations and judgements: prompt, call, extraction, repair and checks as one plan each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import chat, extract, quality, record, validate
from tessera.schema import TAXONOMY, Taxonomy
from tessera.sources import jsonl
from tessera.sources.tables import materialise

SYSTEM = "You write JSON records of conversations between developers and assistants."


def _said(errors):
    return F.array_join(F.transform(errors, lambda e: F.concat(e["field"], F.lit(": "), e["message"])), "; ")


def generate(
    specs: DataFrame, client: Callable, template: str, schema: str = "", tax: Taxonomy = TAXONOMY, max_retries: int = 3, backoff: float = 1.0, parse_retries: int = 2, seed: int | None = None, model: str | None = None, **options
) -> DataFrame:
    """specs with json (the assembled record), reason, detail, seconds and token counts.

    reason is api_error, unexpected_error, generation_error (no JSON object, a structure or values that don't hold) or
    null. A reply without a usable structure is asked for again, parse_retries times. Replies are written before they
    are looked at, so that no request is made twice. Columns of specs that aren't needed are kept.
    """
    asked, done = chat.prompts(specs, template, schema), None
    for k in range(parse_retries + 1):
        said = materialise(chat.chat(asked, client, "prompt", max_retries, backoff, **options), "replies")
        found = said.withColumn("given", record.payload(extract.unwrapped(extract.first_json("reply"))))
        usage = F.struct("prompt_tokens", "completion_tokens", "total_tokens")
        made = found.withColumn("json", F.when(F.col("given").isNotNull(), record.assembled(F.col("given"), F.col("sample_index"), F.concat(F.lit("llm-"), F.col("id")), usage, tax, seed, model)))
        made = validate.with_structure(made, "json", "bad")
        problem = F.when(F.col("given").isNull(), "no JSON object in the reply").when(F.col("json").isNull(), "metadata is not an object").when(F.size("bad") > 0, _said(F.col("bad")))
        made = made.withColumn("detail", F.coalesce("error", problem))
        kind = F.when(F.col("error").isNotNull(), F.col("error_kind")).when(F.col("given").isNotNull() & F.col("json").isNull(), "unexpected_error").when(F.col("detail").isNotNull(), "generation_error")
        made = materialise(made.withColumn("reason", kind).drop("given", "bad"), "records")
        again = made.where("reason = 'generation_error'")
        last = k == parse_retries or again.isEmpty()
        good = made if last else made.where("NOT (reason <=> 'generation_error')")
        done = good if done is None else done.unionByName(good)
        if last:
            break
        asked = again.select(*asked.columns)
    typed = jsonl.parsed(done.select(F.struct("*").alias("row"), "json"), "json").select("row", "record.*")
    typed = typed.select("row", validate.taxonomy_errors(tax).alias("wrong")).select("row.*", "wrong")
    wrong = F.col("reason").isNull() & (F.size("wrong") > 0)
    return typed.withColumn("detail", F.when(wrong, _said(F.col("wrong"))).otherwise(F.col("detail"))).withColumn("reason", F.when(wrong, "generation_error").otherwise(F.col("reason"))).drop("wrong", "prompt", "reply", "error", "error_kind")


def judge(conversations: DataFrame, client: Callable, template: str, schema: str = "", config: quality.QualityConfig = quality.QualityConfig(), attempts: int = 3, **options) -> DataFrame:
    """conversations with dimensions, overall_score, passed and problem. A reply with a problem is asked for again.

    A judge that never answers well leaves passed null: the record goes to the rejected ones, the run goes on.
    """
    asked, done = chat.prompts(conversations, template, schema), None
    for k in range(attempts):
        said = chat.chat(asked, client, **options).withColumn("payload", extract.first_json("reply"))
        said = materialise(said.withColumn("problem", F.when(F.col("payload").isNull(), F.coalesce("error", F.lit("no JSON"))).otherwise(quality.payload_problem("payload"))), "judged")
        good = said if k == attempts - 1 else said.where("problem IS NULL")
        done = good if done is None else done.unionByName(good)
        asked = said.where("problem IS NOT NULL").select(*asked.columns)
        if k < attempts - 1 and asked.isEmpty():
            break
    scored = quality.judged(done.withColumn("dimensions", F.when(F.col("problem").isNull(), quality.payload_scores("payload"))), "dimensions", config)
    return scored.drop("prompt", "reply", "payload", "error", "error_kind")
