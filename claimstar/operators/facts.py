"""The eleven facts. Arguments are staged inputs, or built tables where named after one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimstar.functions.columns import (
    FALSE_TEXTS,
    TRUE_TEXTS,
    arranged,
    in_words,
    lower_text,
    month_of,
    only,
    ratio,
    run_stamp,
    safe_int,
    text_key,
)
from claimstar.functions.joins import (
    KEY_ROWS,
    bounded,
    left_join_null_safe,
    numbered,
    skew_splittable_join,
)
from claimstar.operators.dims import CATEGORY_LEVELS, known_sources
from claimstar.operators.enrich import RISK_COLUMNS, RISK_KEYS, monthly_keys, with_risk
from claimstar.sources.contracts import CONTRACTS, COST_MEASURES, STAMP

ENCOUNTER_KEY = ("encounter_id", "data_source")
ENCOUNTER_AMOUNTS = (
    "paid_amount",
    "allowed_amount",
    "charge_amount",
    "claim_count",
    "inst_claim_count",
    "prof_claim_count",
)

# What a member month and its costs have in common.
CELL = ("person_id", "member_id", "year_month", "data_source", "payer", "plan")

DEFAULT_SPECIALTY_THRESHOLD = 950


def _columns(name: str, first: str, last: str) -> list[str]:
    """The contract columns of an input from ``first`` to ``last``."""
    columns = list(CONTRACTS[name])
    return columns[columns.index(first) : columns.index(last) + 1]


def encounters(
    encounter: DataFrame,
    dim_encounter_group: DataFrame,
    dim_encounter_type: DataFrame,
    key_rows: int | None = KEY_ROWS,
) -> DataFrame:
    """Claim encounters with a mapped group and a mapped type.

    The group comes from the group label alone; the parent group of the type is not compared. Both
    sets have at most ``key_rows`` rows, so encounters are not shuffled by a handful of labels.
    """
    groups = dim_encounter_group.select("encounter_group", "encounter_group_sk")
    groups = bounded(groups, "dim_encounter_group", key_rows)
    kinds = dim_encounter_type.select("encounter_type", "encounter_type_sk")
    kinds = bounded(kinds, "dim_encounter_type", key_rows)
    month = month_of("encounter_start_date")
    return arranged(
        encounter.join(groups, "encounter_group").join(kinds, "encounter_type"),
        "encounter_id",
        "person_id",
        "data_source",
        ("patient_source_key", text_key("person_id", "data_source")),
        ("member_month_sk", text_key("person_id", month)),
        ("year_month", month),
        "encounter_group_sk",
        "encounter_type_sk",
        "encounter_start_date",
        "encounter_end_date",
        *_columns("encounter", "attending_provider_id", "nicu_flag"),
        *_columns("encounter", "primary_diagnosis_code_type", "primary_diagnosis_description"),
        *ENCOUNTER_AMOUNTS,
        "source_model",
        "encounter_source_type",
        STAMP,
    )


def categorized_claims(
    medical_claim: DataFrame,
    dim_service_category: DataFrame,
    dim_data_source: DataFrame | None = None,
    key_rows: int | None = KEY_ROWS,
) -> tuple[DataFrame, str, Column]:
    """Enrolled claim lines of known sources, all of whose category levels are mapped.

    With them the column that tells their category, and the category's key computed from it: lines that
    move carry a small number instead of a key, whose hash does not compress. With ``key_rows`` None they
    carry the key.
    """
    enrolled = known_sources(medical_claim.filter(F.col("enrollment_flag") == 1), dim_data_source)
    key, levels = "service_category_sk", list(CATEGORY_LEVELS)
    categories = dim_service_category.select(key, *levels)
    if key_rows is None:
        return enrolled.join(categories, levels), key, F.col(key)
    number = "service_category_number"
    categories, held = numbered(categories, "dim_service_category", key_rows, number)
    keys = held.select(f"held.{key}").scalar()
    return enrolled.join(categories.drop(key), levels), number, F.get(keys, F.col(number))


def claims(
    medical_claim: DataFrame,
    dim_service_category: DataFrame,
    encounter_enrichment: DataFrame,
    dim_data_source: DataFrame | None = None,
    key_rows: int | None = KEY_ROWS,
) -> DataFrame:
    """Enrolled claim lines with encounter, provider, diagnosis and service category.

    Only the join on the encounter moves claim lines, once. An encounter (or a placeholder id)
    that owns a large share of the lines is split by adaptive execution.
    """
    month = month_of("claim_start_date")
    lines, _, category = categorized_claims(
        medical_claim, dim_service_category, dim_data_source, key_rows
    )
    return arranged(
        skew_splittable_join(lines, encounter_enrichment, ENCOUNTER_KEY),
        "medical_claim_id",
        "encounter_id",
        "encounter_group_sk",
        "encounter_type_sk",
        "primary_diagnosis_code_type",
        "primary_diagnosis_code",
        "primary_diagnosis_description",
        "primary_provider_id",
        "specialty",
        "ccsr_parent_category",
        "ccsr_category",
        "ccsr_category_description",
        "person_id",
        "member_id",
        "member_month_id",
        ("patient_source_key", text_key("person_id", "data_source")),
        ("member_month_sk", text_key("person_id", month)),
        ("year_month", month),
        ("service_category_sk", category),
        "claim_id",
        "claim_line_number",
        "claim_type",
        "payer",
        "plan",
        *_columns("medical_claim", "claim_start_date", "in_network_flag"),
        "data_source",
        STAMP,
    )


def encounter_service_links(
    medical_claim: DataFrame,
    dim_service_category: DataFrame,
    fact_encounters: DataFrame,
    dim_data_source: DataFrame | None = None,
    key_rows: int | None = KEY_ROWS,
) -> DataFrame:
    """Encounter to category links of publishable claims, without building the wide fact.

    Equal to reading them off ``fact_claims``: enrichment adds columns to the encounters but
    neither adds nor drops any. Links are made distinct before they move, so lines of a hot
    encounter shrink to its few categories within each task.
    """
    lines, told_by, category = categorized_claims(
        medical_claim, dim_service_category, dim_data_source, key_rows
    )
    links = lines.select(*ENCOUNTER_KEY, told_by).distinct()
    published = fact_encounters.select(*ENCOUNTER_KEY)
    found = links.join(published, list(ENCOUNTER_KEY), "left_semi")
    return found.select(*ENCOUNTER_KEY, category.alias("service_category_sk"))


def encounter_service_bridge(links: DataFrame, run_ts: str) -> DataFrame:
    """Distinct (encounter, source, service category) of ``fact_claims`` or of its links."""
    return (
        links.select(*ENCOUNTER_KEY, "service_category_sk")
        .distinct()
        .withColumn(STAMP, run_stamp(run_ts))
    )


def admissions(
    augmented_admissions: DataFrame,
    encounter: DataFrame,
    readmissions: DataFrame,
    pqi_summary: DataFrame,
) -> DataFrame:
    """Admitted claim encounters with readmission result; one row per PQI where there are any."""
    key = list(ENCOUNTER_KEY)
    results = readmissions.drop(STAMP)
    indicators = pqi_summary.select(*key, "pqi_number", "pqi_name", F.lit(1).alias("pqi_flag"))
    return (
        augmented_admissions.select(*key)
        .join(encounter, key)
        .join(results, key, "left")
        .join(indicators, key, "left")
        .select(
            "encounter_id",
            "person_id",
            "data_source",
            text_key("person_id", month_of("encounter_start_date")).alias("member_month_sk"),
            text_key("person_id", "data_source").alias("patient_source_key"),
            *_columns("readmissions", "index_admission_flag", "unplanned_readmit_30_flag"),
            F.col("encounter_start_date").alias("admit_date"),
            F.col("encounter_end_date").alias("discharge_date"),
            *_columns("encounter", "length_of_stay", "attending_provider_name"),
            *_columns("encounter", "drg_code_type", "drg_description"),
            *_columns("readmissions", "readmission_encounter_id", "readmission_diagnosis_ccs"),
            F.coalesce("pqi_flag", F.lit(0)).alias("pqi_flag"),
            "pqi_number",
            "pqi_name",
            *ENCOUNTER_AMOUNTS,
            STAMP,
        )
    )


def ed_visits(encounter: DataFrame, ed_classification: DataFrame) -> DataFrame:
    """Emergency department encounters with their classification; order 1 to 3 is avoidable."""
    classes = ed_classification.select(
        *ENCOUNTER_KEY,
        safe_int("ed_classification_order").alias("class_order"),
        F.col("ed_classification_description").alias("class_description"),
    )
    avoidable = F.col("class_order") <= 3
    return (
        encounter.filter(F.col("encounter_type") == "emergency department")
        .join(classes, list(ENCOUNTER_KEY), "left")
        .select(
            "encounter_id",
            "person_id",
            "data_source",
            text_key("person_id", month_of("encounter_start_date")).alias("member_month_sk"),
            F.coalesce("class_order", F.lit(99)).alias("ed_classification_order"),
            F.coalesce("class_description", F.lit("Unclassified")).alias(
                "ed_classification_description"
            ),
            F.when(avoidable, 1).otherwise(0).alias("avoidable"),
            F.when(avoidable, F.col("class_description")).alias("avoidable_description"),
            *ENCOUNTER_AMOUNTS,
            STAMP,
        )
    )


def year_months(
    member_month: DataFrame, risk_scores_monthly: DataFrame, cost: DataFrame
) -> DataFrame:
    """``cell``, total_year_months: per month of a member how many rows its coverage year has.

    A cell is a person's month with one member id, payer, plan and source; its year is that of the
    month. A month counts as many times as it has risk rows times cost rows. The risk rows of a month
    are those of all months with its id, each of which has one where nobody scored it. Only narrow
    columns move, and numbers per cell do from then on: a placeholder member shrinks to a row a month
    before its year is added up.
    """
    n = F.count(F.lit(1))
    scored = monthly_keys(risk_scores_monthly).groupBy(*RISK_KEYS).agg(n.alias("n_scores"))
    months = left_join_null_safe(
        member_month.select("member_month_id", *CELL),
        scored,
        plain=RISK_KEYS[:-1],
        null_safe=RISK_KEYS[-1:],
    )
    # Months without an id or a source have no risk. They stand alone; in the window, all with a null
    # id would be one group.
    without = F.col("member_month_id").isNull() | F.col("data_source").isNull()
    alone = F.when(without, F.struct(*CELL))
    same_id = Window.partitionBy("member_month_id", "data_source", alone)
    own = F.coalesce("n_scores", F.lit(1))
    n_risk = F.when(without, F.lit(1)).otherwise(F.sum(own).over(same_id))
    cells = months.select(F.struct(*CELL).alias("cell"), n_risk.alias("n_risk"))
    cells = cells.groupBy("cell").agg(F.sum("n_risk").alias("n_risk"))
    costs = cost_cells(cost).groupBy("cell").agg(n.alias("n_cost"))
    rows = F.col("n_risk") * F.coalesce("n_cost", F.lit(1))
    year = F.struct(
        *[F.col("cell")[c].alias(c) for c in CELL if c != "year_month"],
        F.substring(F.col("cell")["year_month"], 1, 4).alias("year"),
    )
    total = F.sum(rows).over(Window.partitionBy(year))
    return cells.join(costs, "cell", "left").select("cell", total.alias("total_year_months"))


def cost_cells(cost: DataFrame) -> DataFrame:
    """Costs with the cell they belong to; a missing payer or plan is one of its own, others are not."""
    known = cost.dropna(subset=[c for c in CELL if c not in ("payer", "plan")])
    return known.withColumn("cell", F.struct(*CELL))


def member_months(
    member_month: DataFrame,
    risk_scores_monthly: DataFrame,
    cost: DataFrame,
    member_month_risk: DataFrame | None = None,
) -> DataFrame:
    """Member months with risk, cost and the share of each month in its coverage year.

    Risk is attached by ``member_month_id`` and source (from ``member_month_risk`` where that is at
    hand), so a month without an id gets none, and a month has as many rows as its risk rows times
    its cost rows; ``year_months`` counts them. Whole months move twice: by id to their risk, and by
    cell to the size of their year and their costs, which for both joins is one exchange. Null payers
    and plans match null ones; a null member id never matches cost.
    """
    by_id = ["member_month_id", "data_source"]
    if member_month_risk is None:
        member_month_risk = with_risk(member_month, risk_scores_monthly)
    risk = member_month_risk.select(*by_id, *RISK_COLUMNS).filter("member_month_id is not null")
    months = left_join_null_safe(member_month, risk, plain=by_id, null_safe=[])
    years = year_months(member_month, risk_scores_monthly, cost)
    costs = cost_cells(cost)
    words, amounts = in_words(costs, COST_MEASURES, f"{COST_MEASURES[0]}_and_others")
    costs = only(costs.withColumns(words), ["cell", *words, *[m for m in COST_MEASURES if m not in amounts]])
    celled = months.withColumn("cell", F.struct(*CELL)).drop(*CELL).join(years, "cell", "left")
    share = ratio(F.lit(1), F.col("total_year_months"))
    return arranged(
        celled.join(costs, "cell", "left").withColumns({c: F.col("cell")[c] for c in CELL} | amounts),
        "person_id",
        "member_id",
        "member_month_id",
        "year_nbr",
        "year_month",
        ("member_month_sk", text_key("person_id", "year_month")),
        ("member_months", F.lit(1)),
        "total_year_months",
        ("month_allocation_factor", F.coalesce(share, F.lit(0.0))),
        "data_source",
        "payer",
        "plan",
        ("patient_source_key", text_key("person_id", "data_source")),
        *RISK_COLUMNS,
        *COST_MEASURES,
        STAMP,
    )


def with_drugs(
    pharmacy_claim: DataFrame,
    drug_packages: DataFrame,
    drugs: DataFrame,
    drug_classes: DataFrame,
) -> DataFrame:
    """Pharmacy lines with package, drug and class columns; the drug table wins over the package.

    The tables are joined to each other first, and the lines meet one table by one key: they move
    once, and lines of a hot code, or without a match, are split. Where the joined terminology
    turns out to be within the broadcast threshold, adaptive execution hashes it instead of sorting
    the lines.
    """
    packages = drug_packages.select(
        F.col("ndc11").alias("ndc_code"),
        "drug_id",
        F.col("drug_name").alias("ndc_description"),
        F.col("is_brand").cast("string").alias("package_flag"),
    )
    normalized = drugs.select(
        "drug_id", "drug_name", F.col("is_brand").cast("string").alias("drug_flag")
    )
    terms = packages.filter("ndc_code is not null").join(normalized, "drug_id", "left")
    terms = terms.join(drug_classes, "drug_id", "left")
    named = skew_splittable_join(pharmacy_claim, terms, ["ndc_code"], "left")
    return named.withColumns(
        {
            "drug_name": F.coalesce("drug_name", "ndc_description"),
            "is_brand": F.coalesce("drug_flag", "package_flag"),
        }
    )


def pharmacy_claims(
    pharmacy_claim: DataFrame,
    drug_packages: DataFrame,
    drugs: DataFrame,
    drug_classes: DataFrame,
    practitioner: DataFrame,
    specialty_threshold: float = DEFAULT_SPECIALTY_THRESHOLD,
) -> DataFrame:
    """Pharmacy lines with prescriber specialty, drug terminology and 30-day cost."""
    prescribers = practitioner.select(
        "data_source",
        F.col("practitioner_id").alias("prescribing_provider_id"),
        F.col("specialty").alias("prescribing_specialty"),
    )
    per_day = ratio(F.col("paid_amount"), F.col("days_supply"))
    thirty_days = per_day * 30
    branded = lower_text("is_brand").isin(*TRUE_TEXTS)
    generic = lower_text("is_brand").isin(*FALSE_TEXTS)
    named = with_drugs(pharmacy_claim, drug_packages, drugs, drug_classes)
    return arranged(
        named.join(prescribers, ["data_source", "prescribing_provider_id"], "left"),
        "pharmacy_claim_id",
        "member_id",
        "payer",
        "plan",
        "member_month_id",
        "claim_id",
        "claim_line_number",
        "person_id",
        "data_source",
        ("patient_source_key", text_key("person_id", "data_source")),
        "ndc_code",
        "ndc_description",
        "paid_amount",
        "allowed_amount",
        "prescribing_provider_id",
        "prescribing_provider_name",
        "prescribing_specialty",
        "dispensing_provider_id",
        "dispensing_provider_name",
        "paid_date",
        "dispensing_date",
        "days_supply",
        ("cost_per_day", per_day),
        ("thirty_day_equivalent_cost", thirty_days),
        ("specialty_tier", F.when(thirty_days >= specialty_threshold, 1).otherwise(0)),
        ("rxcui", F.col("drug_id")),
        ("rxnorm_description", F.col("drug_name")),
        ("brand_name", F.when(branded, F.col("drug_name"))),
        ("brand_vs_generic", F.when(branded, "brand").when(generic, "generic")),
        ("ingredient_name", F.lit(None).cast("string")),
        "atc_1_name",
        "atc_2_name",
        "atc_3_name",
        "atc_4_name",
        STAMP,
    )


def hcc_gaps(hcc_suspects: DataFrame) -> DataFrame:
    return only(hcc_suspects, [*CONTRACTS["hcc_suspects"], STAMP])


def quality_measures(staged_measures: DataFrame) -> DataFrame:
    return only(staged_measures, [*CONTRACTS["quality_measures"], STAMP])


def risk_factors(staged_factors: DataFrame) -> DataFrame:
    return only(staged_factors, [*CONTRACTS["risk_factors"], STAMP])


def risk_scores(staged_scores: DataFrame) -> DataFrame:
    return only(staged_scores, [*CONTRACTS["risk_scores"], STAMP])
