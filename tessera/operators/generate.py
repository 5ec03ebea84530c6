"""Row generators: the coverage matrix, scenario and seed conversations, and the clinical table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.core import choice, seeded, uniform
from tessera.schema import SPEC_FIELDS, TAXONOMY, TURNS, Taxonomy

OPENERS = ("Please help with this task.", "Here is a plan and a first version.")
FOLLOW_UPS = ("What about edge cases?", "They are covered as follows.")


def coverage_matrix(spark: SparkSession, count: int, seed: int = 42, taxonomy: Taxonomy = TAXONOMY) -> DataFrame:
    """sample_index, six coordinates and shuffle_key; rows in its order are shuffled by the seed.

    Dimension d of row i is values[(i + d) mod size], so each value of a dimension occurs as often as
    any other, give or take one; which combinations occur follows from the sizes.
    """
    if count < 0 or not all(taxonomy.of(f) for f in SPEC_FIELDS):
        raise ValueError("count must not be negative and no dimension empty")
    i = F.col("id")
    rows = spark.range(count).select(i.alias("sample_index"), *(choice(taxonomy.of(f), i + d).alias(f) for d, f in enumerate(SPEC_FIELDS)))
    return rows.withColumn("shuffle_key", seeded(seed, "sample_index"))


def balance(df: DataFrame, columns=SPEC_FIELDS) -> DataFrame:
    """field, spread: the largest minus the smallest count among a field's values."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns))).alias("x")).select("x.*")
    return long.groupBy("field", "value").count().groupBy("field").agg((F.max("count") - F.min("count")).alias("spread"))


def interaction_pattern(intent) -> Column:
    return (
        F.when(intent == "ask_for_review", "review_findings").when(intent == "ask_for_diagnosis", "multi_turn_debugging")
        .when(intent.isin("ask_for_implementation", "ask_for_tests"), "implementation_with_tests").when(intent == "ask_for_explanation", "design_discussion").otherwise("single_turn_answer")
    )


def turn_count(conversation_length) -> Column:
    out = F.lit(4)
    for k, n in TURNS.items():
        out = F.when(conversation_length == k, n).otherwise(out)
    return out


def messages(turns, topic) -> Column:
    """Alternating user and assistant messages, the first two about the topic."""
    line = lambda i: F.when(i < 2, F.concat(choice(OPENERS, i), F.lit(" "), topic)).otherwise(choice(FOLLOW_UPS, i))
    return F.transform(F.sequence(F.lit(0), turns - 1), lambda i: F.struct(choice(("user", "assistant"), i).alias("role"), line(i).alias("content")))


def scenarios(specs: DataFrame, seed: int = 42, taxonomy: Taxonomy = TAXONOMY) -> DataFrame:
    """A conversation for each spec; ids depend on seed and sample_index alone."""
    i = F.col("sample_index")
    named = F.concat(F.lit("scenario-"), F.format_string("%05d", i), F.lit("-"), F.substring(seeded(seed, i), 1, 8))
    n = turn_count(F.col("conversation_length"))
    return specs.select(
        "sample_index", named.alias("id"), F.col("category").alias("task_type"), *SPEC_FIELDS, choice(taxonomy.languages, F.floor(uniform(seed + 1, i) * len(taxonomy.languages))).alias("language"),
        n.alias("turn_count"), interaction_pattern(F.col("intent")).alias("interaction_pattern"), messages(n, F.replace(F.col("subcategory"), F.lit("_"), F.lit(" "))).alias("messages"),
    )


def seed_conversations(spark: SparkSession, count: int, seed: int = 42, taxonomy: Taxonomy = TAXONOMY) -> DataFrame:
    """Four-turn conversations with task, difficulty and language drawn independently."""
    i = F.col("id")
    draw = lambda k, values: choice(values, F.floor(uniform(f"{seed}:{k}", i) * len(values)))
    rows = spark.range(count).select(i.alias("sample_index"), F.concat(F.lit("conv-"), F.substring(seeded(seed, i), 1, 12)).alias("conv"), draw("t", taxonomy.task_types).alias("task_type"), draw("d", taxonomy.difficulties).alias("difficulty"), draw("l", taxonomy.languages).alias("language"))
    return rows.select("sample_index", F.col("conv").alias("id"), "task_type", "difficulty", "language", messages(F.lit(4), F.replace(F.col("task_type"), F.lit("_"), F.lit(" "))).alias("messages"))


def weighted(u, options) -> Column:
    """The first option whose cumulative weight reaches u times the total."""
    total, out, below = sum(w for _, w in options), F.lit(options[-1][0]), sum(w for _, w in options)
    for value, w in reversed(options):
        out, below = F.when(u * total <= below, F.lit(value)).otherwise(out), below - w
    return out


def clinical(spark: SparkSession, rows: int = 9000, seed: int = 2026) -> DataFrame:
    """27 columns of a synthetic kidney-risk table; each draw depends on seed, row and column alone."""
    draws = iter(range(10_000))
    i = F.col("id")

    def unit() -> Column:
        return uniform(f"{seed}:{next(draws)}", i)

    def gauss(mean: float, sd: float) -> Column:
        return F.lit(mean) + F.lit(sd) * F.sqrt(-2 * F.ln(1 - unit())) * F.cos(2 * F.pi() * unit())

    clip = lambda x, low, high: F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x))
    whole = lambda x, low, high: clip(x, low, high).cast("int")
    over = lambda c, at: F.greatest(F.lit(0.0), (F.col(c) if isinstance(c, str) else c) - at)
    under = lambda c, at: F.greatest(F.lit(0.0), at - F.col(c))
    c = F.col
    # Means, spreads, bounds and weights of the table's columns.
    steps = [
        {"age": whole(gauss(52, 16), 18, 90), "sex": weighted(unit(), [("Female", 0.51), ("Male", 0.49)]), "bmi": F.bround(clip(gauss(27.8, 5.8), 17, 48), 1)},
        {"activity": whole(gauss(145, 85) - over("age", 55) * 1.2, 0, 520)},
        {"daily_steps": whole(gauss(7200, 2600) - over("age", 50) * 55 + c("activity") * 7, 900, 22000), "sleep_hours": F.bround(clip(gauss(6.8, 1.15), 3.5, 10.5), 1)},
        {"stress_score": whole(F.bround(gauss(5.2, 2.1)), 1, 10), "diet": whole(F.bround(gauss(6.1, 2.0) + c("activity") / 180), 1, 10)},
        {"smoking": weighted(unit(), [("Never", 0.58), ("Former", 0.25), ("Current", 0.17)]), "family": weighted(unit(), [("No", 0.78), ("Yes", 0.22)])},
        {"systolic": whole(gauss(122, 16) + over("age", 45) * 0.35 + over("bmi", 27) * 0.9, 88, 205), "diastolic": whole(gauss(78, 10) + over("bmi", 30) * 0.5, 52, 125)},
        {"glucose": whole(gauss(99, 22) + over("bmi", 28) * 1.4 + over("age", 55) * 0.22, 65, 260)},
        {"hba1c": F.bround(clip(gauss(5.7, 0.75) + over("glucose", 105) / 90, 4.5, 11.8), 1), "ldl": whole(gauss(118, 34) + over("bmi", 28) * 1.8 - c("diet") * 1.3, 45, 245)},
        {"hdl": whole(gauss(53, 13) - over("bmi", 28) * 0.8 + c("activity") / 80, 22, 100), "trig": whole(gauss(145, 58) + over("bmi", 28) * 4 + over("glucose", 100) * 0.35, 45, 430)},
        {"cholesterol": whole(c("ldl") + c("hdl") + c("trig") / 5 + gauss(8, 10), 110, 360), "egfr": F.bround(clip(116 - c("age") * 0.62 - over("systolic", 125) * 0.18 - over("hba1c", 5.7) * 4.8 + gauss(0, 13), 12, 125), 1)},
        {"creatinine": F.bround(clip(105 / F.greatest(c("egfr"), F.lit(12.0)) + F.when(c("sex") == "Male", 0.12).otherwise(0.0) + gauss(0, 0.12), 0.45, 6.2), 2)},
        {"bun": whole(gauss(15, 5) + under("egfr", 70) * 0.22, 6, 70), "uacr": whole(F.exp(gauss(3.0, 0.85)) + over("systolic", 130) * 1.2 + over("hba1c", 6.0) * 28, 3, 1800)},
        {"potassium": F.bround(clip(gauss(4.25, 0.38) + under("egfr", 45) * 0.012, 3.1, 6.4), 1), "hemoglobin": F.bround(clip(gauss(13.7, 1.2) - under("egfr", 55) * 0.025, 8.5, 17.5), 1)},
    ]
    df = spark.range(1, rows + 1)
    for step in steps:
        df = df.withColumns(step)
    hinges = (("age", 45, 0.42), ("bmi", 27, 1.25), ("systolic", 120, 0.38), ("hba1c", 5.7, 9.0), ("glucose", 100, 0.13), ("creatinine", 1.0, 12.0), ("uacr", 30, 0.035), ("ldl", 120, 0.08), ("trig", 160, 0.035))
    risk = sum((over(x, at) * w for x, at, w in hinges), under("egfr", 90) * 0.55 + under("hdl", 50) * 0.22 + c("stress_score") * 1.25 + F.abs(c("sleep_hours") - 7.2) * 3.2)
    risk = risk - F.least(c("activity"), F.lit(300)) * 0.035 - over("daily_steps", 5000) * 0.0014 - c("diet") * 1.35
    risk = risk + F.when(c("smoking") == "Current", 8.5).when(c("smoking") == "Former", 3.5).otherwise(0.0) + F.when(c("family") == "Yes", 9.0).otherwise(0.0) + gauss(0, 8.5)
    df = df.withColumn("risk", F.bround(clip(risk, 0, 100), 1))
    return df.select(
        F.concat(F.lit(f"CKD{seed}_"), F.format_string("%05d", i)).alias("patient_id"), "age", "sex", "bmi", c("systolic").alias("systolic_bp"), c("diastolic").alias("diastolic_bp"), c("glucose").alias("fasting_blood_glucose_mg_dl"),
        c("hba1c").alias("hba1c_percent"), c("creatinine").alias("serum_creatinine_mg_dl"), c("bun").alias("bun_mg_dl"), c("egfr").alias("egfr_ml_min_1_73m2"), c("uacr").alias("urine_albumin_creatinine_ratio_mg_g"),
        c("potassium").alias("serum_potassium_mmol_l"), c("hemoglobin").alias("hemoglobin_g_dl"), c("cholesterol").alias("total_cholesterol_mg_dl"), c("ldl").alias("ldl_mg_dl"), c("hdl").alias("hdl_mg_dl"), c("trig").alias("triglycerides_mg_dl"),
        c("smoking").alias("smoking_status"), c("activity").alias("physical_activity_minutes_per_week"), "daily_steps", "sleep_hours", "stress_score", c("diet").alias("diet_quality_score"), c("family").alias("family_history_kidney_disease"),
        c("risk").alias("ckd_risk_score"), (c("risk") >= 37).cast("int").alias("ckd_diagnosis"),
    )
