"""python -m tessera.cli COMMAND: generate, generate-llm, clinical, validate, evaluate, split, docs.

Models are reached through --client MODULE:FUNCTION, a function that makes a client: prompt -> {text, usage}.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from dataclasses import asdict
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.core import seeded
from tessera.operators import attempts, dedup, generate, model, quality, report, run, split, stats, validate
from tessera.sources import jsonl
from tessera.sources.tables import materialise


def _client(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _records(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """The typed records of the valid lines with their order, and how many were loaded and skipped."""
    lines = jsonl.lines(spark, path)
    counts = jsonl.skipped(lines).first().asDict()
    return jsonl.parsed(jsonl.tolerant(lines)).select(F.col("ord").alias("conv_id"), "record.*"), counts


def cmd_generate(spark, a) -> int:
    """Scenarios in seeded order."""
    jsonl.write(generate.scenarios(generate.coverage_matrix(spark, a.count, a.seed).orderBy("shuffle_key"), a.seed), a.out)
    return 0


def cmd_clinical(spark, a) -> int:
    """Writes the clinical table as CSV and checks what can be read back."""
    jsonl.write_csv(generate.clinical(spark, a.rows, a.seed), a.out)
    rows = jsonl.read_csv(spark, a.out)
    said = stats.csv_report(rows).first().asDict() | stats.prevalence(rows, "ckd_diagnosis").first().asDict()
    print(json.dumps(said))
    return int((said["n_rows"], said["n_columns"], said["empty_cells"] or 0) != (a.rows, 27, 0))


def cmd_generate_llm(spark, a) -> int:
    """Makes what is missing of count samples. Waves are appended as they end, so an ended run goes on where it was."""
    text = lambda name: jsonl.text_resource(a.prompts, name) if name else ""
    client = lambda name: _client(name) if name else None
    options = {"seed": a.seed, "model": a.model, "system": model.SYSTEM, "temperature": a.temperature}
    made = run.Run(_client(a.client), text(a.template), client(a.encoder), client(a.judge), text(a.judge and a.judge_template), a.similarity, quality.QualityConfig(a.threshold), max_attempts=a.attempts, options=options)
    wanted = generate.scenarios(generate.coverage_matrix(spark, a.count, a.seed), a.seed)
    existing = None
    if jsonl.exists(spark, a.out):
        existing = materialise(run.produced(jsonl.lines(spark, a.out)), "existing")
        wanted = attempts.missing(wanted, existing)
    if wanted.isEmpty():
        return 0

    def ended(good: DataFrame, bad: DataFrame) -> None:
        good.select(F.col("json").alias("value")).write.mode("append").text(a.out)
        run.failures(bad).write.mode("append").json(a.failures)

    good, bad = made(wanted, existing, ended)
    tried = good.unionByName(bad)
    print(attempts.summary(attempts.run_metrics(tried).first().asDict(), [tuple(r) for r in attempts.reasons(tried).collect()]))
    return 0


def cmd_validate(spark, a) -> int:
    lines = jsonl.strict(jsonl.lines(spark, a.path))
    rows = validate.with_structure(jsonl.parsed(lines)).select(validate.record_id("line").alias("rid"), "structure", "record.*")
    found = validate.errors(rows, F.when(F.size("structure") > 0, F.col("structure")).otherwise(validate.all_errors(generator=True)), "rid")
    n = 0
    for n, r in enumerate(found.toLocalIterator(), 1):
        print(f"{r.rid}: {r.field}: {r.message}")
    return int(n > 0)


def cmd_evaluate(spark, a) -> int:
    rows, counts = _records(spark, a.path)
    if not counts["loaded"]:
        return 1
    done = model.judge(rows, _client(a.client), jsonl.text_resource(a.prompts, a.template), config=quality.QualityConfig(a.threshold))
    done.select("id", "overall_score", "passed", "problem").write.mode("overwrite").json(a.out)
    said = quality.tally(spark.read.json(a.out).withColumn("passed", F.coalesce("passed", F.lit(False)))).first()
    print(json.dumps(said.asDict()))
    return int(said.failed > 0)


def cmd_split(spark, a) -> int:
    rows, counts = _records(spark, a.path)
    twice = [r[0] for r in dedup.duplicate_ids(rows).orderBy("id").limit(5).collect()]
    if twice:
        raise ValueError(f"ids occur more than once: {twice}")
    kept = dedup.keep_first(rows, dedup.content_hash(), "conv_id")
    done = split.assert_sound(split.stratified(kept, ("category", "difficulty", "intent"), "id", split.SplitConfig(a.train, a.validation, a.test, a.seed)), "id")
    jsonl.write_splits(done.drop("conv_id"), a.out, seeded(a.seed, "id"))
    jsonl.write_info(report.statistics(done), a.statistics)
    if a.info:
        about = {"name": a.name, "created_at": datetime.now(UTC).isoformat()}
        jsonl.write_info(asdict(report.dataset_info(done, **about)), a.info)
    print(json.dumps(counts))
    return 0


def cmd_docs(spark, a) -> int:
    """Dataset info, statistics and conversations are each optional; what is missing has a default."""
    s = report.load_statistics(a.statistics)
    given = {"name": a.name, "splits": s.get("splits", {})}
    info = report.DatasetInfo.load(a.info, **given)
    examples = []
    if a.path and jsonl.exists(spark, a.path):
        rows, _ = _records(spark, a.path)
        first = report.example_per_difficulty(rows)
        examples = [json.loads(x) for x in rows.join(F.broadcast(first.select("conv_id")), "conv_id").orderBy("conv_id").drop("conv_id").toJSON().collect()]
    print("\n".join(report.write_docs(a.out, info, s, examples)))
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name, f, /, **options):
        c = sub.add_parser(name)
        c.set_defaults(run=f)
        for key, default in options.items():
            c.add_argument(f"--{key.replace('_', '-')}", required=default is None, default=default, type=type(default) if default is not None else str)

    command("generate", cmd_generate, out=None, count=84, seed=42)
    command("generate-llm", cmd_generate_llm, out=None, failures=None, client=None, prompts=None, template="generate.txt", judge="", judge_template="judge.txt", encoder="", model="", count=84, seed=42, attempts=5, similarity=0.92, threshold=0.7, temperature=0.7)
    command("validate", cmd_validate, path=None)
    command("evaluate", cmd_evaluate, path=None, out=None, client=None, prompts=None, template="judge.txt", threshold=0.7)
    command("clinical", cmd_clinical, out=None, rows=9000, seed=2026)
    command("split", cmd_split, path=None, out=None, statistics=None, info="", name="conversations", train=0.8, validation=0.1, test=0.1, seed=42)
    command("docs", cmd_docs, out=None, path="", statistics="", info="", name="conversations")
    return p


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    return a.run(SparkSession.builder.appName(f"tessera-{a.command}").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
