"""The registered query of each operator, with production parameters, and its SQL where SQL can state it."""

from __future__ import annotations

from tessera.llm import chat_format, decontaminate, exact_dedup, html_extract, language_id, lm_score, near_dedup, packing, token_counts, url_filter


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES = {
    "op1_lm_score": lambda spark, d: lm_score.lm_score(table(spark, d, "documents")),
    "op2_exact_dedup": lambda spark, d: exact_dedup.exact_dedup(table(spark, d, "documents")),
    "op3_decontaminate": lambda spark, d: decontaminate.decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op4_near_dedup": lambda spark, d: near_dedup.near_dedup(table(spark, d, "documents")),
    "op5_packing": lambda spark, d: packing.pack_documents(table(spark, d, "documents"), every=packing.ASKING),
    "op6_chat_format": lambda spark, d: chat_format.chat_format(table(spark, d, "conversations")),
    "op7_language_id": lambda spark, d: language_id.identify(table(spark, d, "documents")),
    "op8_url_filter": lambda spark, d: url_filter.judge(table(spark, d, "pages")),
    "op9_html_extract": lambda spark, d: html_extract.extract_pages(table(spark, d, "pages")),
    "op10_token_counts": lambda spark, d: token_counts.document_token_counts(table(spark, d, "documents")),
}
ORACLE_SQL = {
    "op2_exact_dedup": exact_dedup.ORACLE_SQL,
    "op3_decontaminate": decontaminate.ORACLE_SQL,
    "op4_near_dedup": near_dedup.ORACLE_SQL,
    "op6_chat_format": chat_format.ORACLE_SQL,
    "op8_url_filter": url_filter.ORACLE_SQL,
}
