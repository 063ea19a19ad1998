"""The two intermediate relations: encounter enrichment and member-month risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstar.functions.columns import lower_text, month_of, ratio
from claimstar.functions.joins import bounded, left_join_null_safe, skew_splittable_join

RISK_COLUMNS = (
    "risk_model_code",
    "normalized_risk_score",
    "population_normalized_risk_score",
)
# What a member month and its scores have in common; the last one, the payer, may be null in both.
RISK_KEYS = ("person_id", "year_month", "data_source", "payer")
MEAN_ROWS = 100_000  # most (month, source) pairs whose means are taken as small


def encounter_enrichment(
    fact_encounters: DataFrame, dim_encounter_provider: DataFrame, diagnosis_categories: DataFrame
) -> DataFrame:
    """Encounter keys and diagnosis with top provider and first-ranked diagnosis category."""
    # Only ICD-10-CM codes are looked up. Masking the code keeps the other encounters, as a
    # condition inside the left join would, and leaves a plain equi join.
    code = F.when(
        lower_text("primary_diagnosis_code_type") == "icd-10-cm", F.col("primary_diagnosis_code")
    )
    categories = diagnosis_categories.filter(F.col("ccsr_category_rank") == 1).select(
        F.col("code").alias("icd_10_code"),
        "ccsr_parent_category",
        "ccsr_category",
        "ccsr_category_description",
    )
    providers = dim_encounter_provider.select(
        "encounter_id", "data_source", "primary_provider_id", "specialty"
    )
    return (
        fact_encounters.join(providers, ["encounter_id", "data_source"], "left")
        .withColumn("icd_10_code", code)
        .join(categories, "icd_10_code", "left")
        .select(
            "encounter_id",
            "encounter_group_sk",
            "encounter_type_sk",
            "primary_diagnosis_code_type",
            "primary_diagnosis_code",
            "primary_diagnosis_description",
            "data_source",
            "primary_provider_id",
            "specialty",
            "ccsr_parent_category",
            "ccsr_category",
            "ccsr_category_description",
        )
    )


def monthly_keys(risk_scores_monthly: DataFrame, *others: str) -> DataFrame:
    """The keys of monthly scores, and other columns of theirs."""
    month = month_of("collection_end_date").alias("year_month")
    return risk_scores_monthly.select("person_id", month, "data_source", "payer", *others)


def monthly_means(risk_scores_monthly: DataFrame) -> DataFrame:
    """The mean score of every month and source, over all its score rows."""
    scores = monthly_keys(risk_scores_monthly, "normalized_risk_score")
    # Sum and count instead of avg: exact for decimals, so the mean does not depend on the
    # order in which tasks finish.
    return scores.groupBy("year_month", "data_source").agg(
        ratio(F.sum("normalized_risk_score"), F.count("normalized_risk_score")).alias("mean_score")
    )


def monthly_risk(risk_scores_monthly: DataFrame, mean_rows: int | None = MEAN_ROWS) -> DataFrame:
    """Monthly person scores with their ratio to the mean of the same month and source.

    The mean is over every score row of that month and source, member month or not. A person's
    score and the mean it is compared with share month and source, so the ratio is formed here,
    on the narrow score rows, and member months need one join instead of two. The means, a row per
    month and source, are at most ``mean_rows`` and meet the scores where these lie; with
    ``mean_rows`` None the scores are shuffled by month and source where Spark estimates more.
    """
    scores = monthly_keys(risk_scores_monthly, "normalized_risk_score", "risk_model_code")
    means, keys = monthly_means(risk_scores_monthly), ["year_month", "data_source"]
    if mean_rows is None:
        compared = skew_splittable_join(scores, means, keys, "left")
    else:
        compared = scores.join(bounded(means, "the means per month and source", mean_rows), keys, "left")
    return compared.withColumn(
        "population_normalized_risk_score",
        ratio(F.col("normalized_risk_score"), F.col("mean_score")),
    ).drop("mean_score")


def with_risk(
    member_month: DataFrame, risk_scores_monthly: DataFrame, mean_rows: int | None = MEAN_ROWS
) -> DataFrame:
    """Member months with the three risk columns; person, month, payer and source must agree."""
    return left_join_null_safe(
        member_month,
        monthly_risk(risk_scores_monthly, mean_rows),
        plain=RISK_KEYS[:-1],
        null_safe=RISK_KEYS[-1:],
    )


def member_month_risk(
    member_month: DataFrame, risk_scores_monthly: DataFrame, mean_rows: int | None = MEAN_ROWS
) -> DataFrame:
    return with_risk(member_month, risk_scores_monthly, mean_rows).select(
        "member_month_id", "data_source", *RISK_COLUMNS
    )
