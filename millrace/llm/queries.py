"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    collocations,
    decontaminate,
    html_text,
    language,
    lexical,
    licenses,
    mixing,
    near_dups,
    neighbours,
    secrets,
    token_counts,
    toxicity,
)
from millrace.llm.oracle import llm_oracles  # noqa: F401  (the SQL of these queries, for their register)
from millrace.llm.tables import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = language.identify_languages(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", F.col("lang").alias("declared"), "language.*")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("licenses", lambda p: p["base"])

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    starts = F.transform(base, lambda p: p["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("licenses")).alias("labels"),
        F.coalesce(F.array_max(F.transform("licenses", lambda p: p["worth"])), F.lit(0.0)).alias("score"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lengths = token_counts.token_lengths(docs, str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    return token_counts.length_histogram(lengths)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.default_vocabulary())


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["kind"] != "random")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, ("assign", "access", "hex", "random")),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_licenses": op2_licenses,
        "op3_token_counts": op3_token_counts,
        "op4_nearest": op4_nearest,
        "op5_bpe": op5_bpe,
        "op6_secrets": op6_secrets,
        "op7_main_text": op7_main_text,
        "op8_decontamination": op8_decontamination,
        "op9_toxicity": op9_toxicity,
        "op10_near_duplicates": op10_near_duplicates,
        "op11_collocations": op11_collocations,
        "op12_mixture": op12_mixture,
        "op13_ranked_search": op13_ranked_search,
    }
