"""The eight dimensions. Every argument is a staged input unless it is named ``dim_*``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstar.functions.columns import run_stamp, surrogate_key, text_key
from claimstar.functions.joins import skew_splittable_join
from claimstar.sources.contracts import ATTRIBUTION, CONTRACTS, STAMP

SOURCE = "data_source"
CATEGORY_LEVELS = ("service_category_1", "service_category_2", "service_category_3")


def data_source(
    eligibility: DataFrame, medical_claim: DataFrame, pharmacy_claim: DataFrame, run_ts: str
) -> DataFrame:
    """One row per source seen in eligibility, medical or pharmacy claims."""
    # One distinct over the union: its map-side half already leaves each task with a few rows.
    sources = (
        eligibility.select(SOURCE)
        .unionByName(medical_claim.select(SOURCE))
        .unionByName(pharmacy_claim.select(SOURCE))
        .distinct()
    )
    return sources.select(
        surrogate_key(SOURCE).alias("data_source_sk"), SOURCE, run_stamp(run_ts).alias(STAMP)
    )


def date(calendar: DataFrame, medical_claim: DataFrame) -> DataFrame:
    """Calendar days from the first to the last claim start date, both included."""
    # The two bounds are scalar subqueries, merged into one scan of the date column. Without
    # claims they are null and no day qualifies.
    first = medical_claim.agg(F.min("claim_start_date")).scalar()
    last = medical_claim.agg(F.max("claim_start_date")).scalar()
    return (
        calendar.filter(F.col("full_date").between(first, last))
        .select(*CONTRACTS["calendar"], STAMP)
        .distinct()
    )


def encounter_group(encounter_group_keys: DataFrame, run_ts: str) -> DataFrame:
    return encounter_group_keys.withColumn(STAMP, run_stamp(run_ts))


def encounter_type(encounter_type_keys: DataFrame, run_ts: str) -> DataFrame:
    return encounter_type_keys.select(
        "encounter_type",
        "encounter_type_sk",
        "encounter_group_sk",
        run_stamp(run_ts).alias(STAMP),
    )


def practitioner_by_npi(practitioner: DataFrame) -> DataFrame:
    """One specialty per NPI and source: lowest practitioner id, then lowest specialty."""
    first = F.min(
        F.struct(
            F.col("practitioner_id").isNull().alias("no_id"),
            "practitioner_id",
            F.col("specialty").isNull().alias("no_specialty"),
            "specialty",
        )
    )
    return (
        practitioner.groupBy("npi", SOURCE)
        .agg(first.alias("first"))
        .select("npi", SOURCE, F.col("first.specialty").alias("specialty"))
    )


def known_sources(frame: DataFrame, dim_data_source: DataFrame | None) -> DataFrame:
    """Rows whose source is in the dimension.

    The dimension is built from the very claims it is joined to, so unless another one is
    handed in, membership comes down to a non-null source. That needs no scan, and no join on
    the few values of the source, which would put most lines into one task if it were shuffled.
    """
    if dim_data_source is None:
        return frame.filter(F.col(SOURCE).isNotNull())
    return frame.join(dim_data_source.select(SOURCE), SOURCE, "left_semi")


def encounter_provider(
    medical_claim: DataFrame,
    practitioner: DataFrame,
    dim_data_source: DataFrame | None = None,
    stamped: bool = True,
) -> DataFrame:
    """Highest-paid rendering provider of each encounter and source.

    Ties go to the lowest NPI, a missing NPI last. The specialty depends on (NPI, source) alone
    once practitioners are deduplicated, so it cannot change a sum or a tie: the practitioner
    join is left until one row per encounter remains. Both steps are aggregates with a map-side
    half, which keeps claims without an encounter id (one group per source) from piling up in
    one task the way a window over them would. Where the run stamp is not wanted, it does not move.
    """
    stamps = [STAMP] if stamped else []
    paid = (
        known_sources(medical_claim, dim_data_source)
        .groupBy("encounter_id", SOURCE, "rendering_npi")
        .agg(F.sum("paid_amount").alias("paid"), *[F.max(s).alias(s) for s in stamps])
    )
    top = F.min(
        F.struct(
            (-F.coalesce("paid", F.lit(0))).alias("minus_paid"),
            F.col("rendering_npi").isNull().alias("no_npi"),
            "rendering_npi",
            *stamps,
        )
    )
    winners = (
        paid.groupBy("encounter_id", SOURCE)
        .agg(top.alias("top"))
        .select(
            "encounter_id",
            SOURCE,
            F.col("top.rendering_npi").alias("npi"),
            *[F.col(f"top.{s}").alias(s) for s in stamps],
        )
    )
    specialties = practitioner_by_npi(practitioner)
    return skew_splittable_join(winners, specialties, ["npi", SOURCE], "left").select(
        "encounter_id", SOURCE, F.col("npi").alias("primary_provider_id"), "specialty", *stamps
    )


def member(patient: DataFrame) -> DataFrame:
    columns = list(CONTRACTS["patient"])
    person_sk = text_key("person_id", SOURCE).alias("person_sk")
    return patient.select(columns[0], person_sk, *columns[1:], STAMP)


def member_months(member_month: DataFrame) -> DataFrame:
    return member_month.select(
        "person_id",
        "year_nbr",
        "year_month",
        "member_month_id",
        "member_id",
        text_key("person_id", "year_month").alias("member_month_sk"),
        SOURCE,
        text_key("person_id", SOURCE).alias("patient_source_key"),
        "payer",
        "plan",
        *ATTRIBUTION,
        STAMP,
    )


def service_category(service_categories: DataFrame, run_ts: str) -> DataFrame:
    """Distinct three-level categories; a combination with null levels gets a key as well."""
    return (
        service_categories.select(*CATEGORY_LEVELS)
        .distinct()
        .select(
            surrogate_key(*CATEGORY_LEVELS).alias("service_category_sk"),
            *CATEGORY_LEVELS,
            run_stamp(run_ts).alias(STAMP),
        )
    )
