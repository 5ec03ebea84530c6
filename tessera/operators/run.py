"""The generation run: waves of attempts, each generate, validate, dedup and judge, appended as they end, resumed by index.

A wave makes one attempt at every sample that has no record yet, so samples are tried side by side; within a wave
the rules are those of samples taken in order of their index: a record is a duplicate if it is similar to an accepted
one, and only what passes every check is accepted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import attempts, dedup, model, quality, validate
from tessera.schema import SPEC_FIELDS, TAXONOMY, Taxonomy
from tessera.sources import jsonl
from tessera.sources.tables import materialise


@dataclass
class Run:
    """What a run uses. Without encoder no record is a duplicate, without judge none fails in quality.

    client, judge: make a function of a prompt (see chat.chat); encoder: makes a function from texts to vectors.
    """

    client: Callable
    template: str
    encoder: Callable | None = None
    judge: Callable | None = None
    judge_template: str = ""
    similarity: float = 0.92
    quality: quality.QualityConfig = field(default_factory=quality.QualityConfig)
    taxonomy: Taxonomy = TAXONOMY
    max_attempts: int = 5
    options: dict = field(default_factory=dict)

    def __post_init__(self):
        if not -1 <= self.similarity <= 1:
            raise ValueError("similarity must be in [-1, 1]")
        if self.max_attempts < 1:
            raise ValueError("at least one attempt is needed")

    def checked(self, made: DataFrame) -> DataFrame:
        """made with the reason validation_failed where a record breaks a rule, and text, what is embedded."""
        typed = jsonl.parsed(made.select(F.struct("*").alias("row"), "json"), "json").select("row", "record.*")
        found = typed.select("row", validate.all_errors(self.taxonomy, generator=True).alias("wrong"), dedup.embedding_text().alias("text")).select("row.*", "wrong", "text")
        wrong = F.col("reason").isNull() & (F.size("wrong") > 0)
        said = F.array_join(F.transform("wrong", lambda e: F.concat(e["field"], F.lit(": "), e["message"])), "; ")
        return found.withColumn("detail", F.when(wrong, said).otherwise(F.col("detail"))).withColumn("reason", F.when(wrong, "validation_failed").otherwise(F.col("reason"))).drop("wrong")

    def vectors(self, rows: DataFrame) -> DataFrame:
        """sample_index, embedding."""
        return materialise(dedup.embed(rows.select("sample_index", "text"), self.encoder, "text", keep=["sample_index"]), "vectors")

    def judged(self, rows: DataFrame) -> DataFrame:
        """sample_index, passed, and why not."""
        typed = jsonl.parsed(rows.select("sample_index", "json"), "json").select("sample_index", "record.*")
        done = model.judge(typed, self.judge, self.judge_template, config=self.quality)
        scores = F.array_join(F.transform("dimensions", lambda d: F.concat(d["name"], F.lit("="), d["score"].cast("string"), F.lit("/10"))), ", ")
        why = F.coalesce("problem", F.concat(F.lit("overall="), F.format_string("%.4f", "overall_score"), F.lit(f" < threshold={self.quality.threshold} ("), scores, F.lit(")")))
        return materialise(done.select("sample_index", F.coalesce("passed", F.lit(False)).alias("passed"), why.alias("why")), "judged")

    def attempt(self, specs: DataFrame, number: int, accepted: DataFrame | None) -> DataFrame:
        """specs with json, reason, detail, seconds. accepted: sample_index and embedding of the records so far."""
        specs = specs.withColumn("attempt", F.lit(number))
        rows = materialise(self.checked(model.generate(specs, self.client, self.template, tax=self.taxonomy, **self.options)), "checked")
        valid = rows.where("reason IS NULL")
        index = F.col("sample_index")
        outcome = None  # sample_index, reason, detail of what fails below
        if self.encoder:
            vectors = self.vectors(valid)
            if accepted is not None:
                twins = materialise(dedup.best_match(vectors, accepted, self.similarity, "sample_index"), "twins")
                outcome = twins.select(F.col("candidate").alias("sample_index"), F.lit("duplicate").alias("reason"), _duplicate("candidate", "canonical"))
                valid, vectors = (x.join(twins, index == F.col("candidate"), "left_anti") for x in (valid, vectors))
        judged = self.judged(valid) if self.judge else valid.select("sample_index", F.lit(True).alias("passed"), F.lit("").alias("why"))
        if self.encoder:
            _, twins = dedup.greedy(vectors.join(judged.select("sample_index", "passed"), "sample_index"), self.similarity, "sample_index", able="passed")
            twins = materialise(twins, "twins").select(F.col("duplicate").alias("sample_index"), F.lit("duplicate").alias("reason"), _duplicate("duplicate", "canonical"))
            outcome = twins if outcome is None else outcome.unionByName(twins)
            judged = judged.join(twins, "sample_index", "left_anti")
        low = judged.where("NOT passed").select("sample_index", F.lit("quality_failed").alias("reason"), F.col("why").alias("detail"))
        outcome = (low if outcome is None else outcome.unionByName(low)).select("sample_index", F.col("reason").alias("later"), F.col("detail").alias("why"))
        return rows.join(outcome, "sample_index", "left").withColumn("reason", F.coalesce("reason", "later")).withColumn("detail", F.coalesce("detail", "why")).drop("later", "why")

    def __call__(self, wanted: DataFrame, existing: DataFrame | None = None, each: Callable[[DataFrame, DataFrame], None] = lambda good, bad: None) -> tuple[DataFrame, DataFrame]:
        """(accepted, rejected attempts) of the samples wanted. existing: sample_index and text of records made before.

        each: called with a wave's accepted and rejected rows when it ends.
        """
        known = [] if existing is None or not self.encoder else [self.vectors(existing)]

        def attempt(specs: DataFrame, number: int) -> DataFrame:
            before = known[0] if known else None
            for more in known[1:]:
                before = before.unionByName(more)
            return self.attempt(specs, number, before)

        def ended(good: DataFrame, bad: DataFrame) -> None:
            if self.encoder:
                known.append(self.vectors(good))
            each(good, bad)

        return attempts.waves(wanted, attempt, self.max_attempts, each=ended)


def _duplicate(one: str, other: str):
    return F.concat(F.lit("sample "), F.col(one).cast("string"), F.lit(" duplicates sample "), F.col(other).cast("string"), F.lit(" similarity="), F.format_string("%.4f", "similarity")).alias("detail")


def produced(lines: DataFrame, tax: Taxonomy = TAXONOMY) -> DataFrame:
    """sample_index and text of the valid records among the lines that a run wrote; other lines don't count, their samples are made anew."""
    rows = jsonl.parsed(jsonl.tolerant(lines)).select(F.get_json_object("line", "$.generator.parameters.sample_index").cast("long").alias("sample_index"), "record.*")
    rows = rows.where(F.col("sample_index").isNotNull() & (F.size(validate.all_errors(tax, generator=True)) == 0))
    return rows.select("sample_index", dedup.embedding_text().alias("text")).dropDuplicates(["sample_index"])


def failures(bad: DataFrame) -> DataFrame:
    """The failure log: one row a rejected attempt. raw_data: the record, where there was one to check."""
    late = F.col("reason").isin("validation_failed", "duplicate", "quality_failed")
    spec = F.struct(*(F.col(f) for f in SPEC_FIELDS)).alias("scenario_spec")
    return bad.select(F.current_timestamp().alias("timestamp"), "sample_index", "attempt", F.concat_ws(": ", "reason", "detail").alias("reason"), spec, F.when(late, F.col("json")).alias("raw_data"))
