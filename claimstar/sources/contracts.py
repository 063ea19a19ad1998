"""Input contracts: the columns each input relation must offer, and the kind of each.

A contract is checked against the schema only; no job runs and nothing is cast. Numeric
columns may be any numeric type, so fractional quantities stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from claimstar.functions.columns import only

STAMP = "last_run_ts"

# The care settings for which member-month cost is split, in published order.
COST_SETTINGS = (
    "inpatient",
    "outpatient",
    "office_based",
    "ancillary",
    "other",
    "pharmacy",
    "acute_inpatient",
    "ambulance",
    "ambulatory_surgery_center",
    "dialysis",
    "durable_medical_equipment",
    "emergency_department",
    "home_health",
    "inpatient_hospice",
    "inpatient_psychiatric",
    "inpatient_rehabilitation",
    "lab",
    "observation",
    "office_based_other",
    "office_based_pt_ot_st",
    "office_based_radiology",
    "office_based_surgery",
    "office_based_visit",
    "outpatient_hospice",
    "outpatient_hospital_or_clinic",
    "outpatient_pt_ot_st",
    "outpatient_psychiatric",
    "outpatient_radiology",
    "outpatient_rehabilitation",
    "outpatient_surgery",
    "skilled_nursing",
    "telehealth_visit",
    "urgent_care",
)
COST_TOTALS = ("total_paid", "medical_paid", "total_allowed", "medical_allowed")
COST_MEASURES = (
    *(f"{s}_paid" for s in COST_SETTINGS),
    *(f"{s}_allowed" for s in COST_SETTINGS),
    *COST_TOTALS,
)

ATTRIBUTION = (
    "payer_attributed_provider",
    "payer_attributed_provider_practice",
    "payer_attributed_provider_organization",
    "payer_attributed_provider_lob",
    "custom_attributed_provider",
    "custom_attributed_provider_practice",
    "custom_attributed_provider_organization",
    "custom_attributed_provider_lob",
    "default_attributed_provider",
    "default_attributed_provider_bucket",
    "default_attributed_provider_specialty",
)

# Column name, then its kind unless it is text.
# Kinds: text, int (whole numbers and 0/1 flags), number, date, time, loose (a flag or an order
# that arrives as text, boolean or whole number).
_COLUMNS = {
    "eligibility": "data_source",
    "patient": """
        person_id, name_suffix, first_name, middle_name, last_name, sex, race,
        birth_date date, death_date date, death_flag int, address, city, state, zip_code,
        county, latitude number, longitude number, phone, email, ethnicity, data_source,
        age int, age_group
    """,
    "encounter": """
        encounter_id, person_id, encounter_type, encounter_group,
        encounter_start_date date, encounter_end_date date, length_of_stay int,
        admit_source_code, admit_source_description, admit_type_code, admit_type_description,
        discharge_disposition_code, discharge_disposition_description,
        attending_provider_id, attending_provider_name,
        facility_npi, facility_name, facility_type,
        observation_flag int, lab_flag int, dme_flag int, ambulance_flag int,
        pharmacy_flag int, ed_flag int, delivery_flag int, delivery_type,
        newborn_flag int, nicu_flag int, snf_part_b_flag int,
        primary_diagnosis_code_type, primary_diagnosis_code, primary_diagnosis_description,
        drg_code_type, drg_code, drg_description,
        paid_amount number, allowed_amount number, charge_amount number,
        claim_count int, inst_claim_count int, prof_claim_count int,
        source_model, data_source, encounter_source_type
    """,
    "medical_claim": """
        medical_claim_id, encounter_id, person_id, member_id, claim_id,
        claim_line_number int, member_month_id, claim_type, payer, plan,
        encounter_type, encounter_group, claim_start_date date, claim_end_date date,
        claim_line_start_date date, claim_line_end_date date,
        admission_date date, discharge_date date,
        admit_source_code, admit_source_description, admit_type_code, admit_type_description,
        discharge_disposition_code, discharge_disposition_description,
        place_of_service_code, place_of_service_description,
        bill_type_code, bill_type_description, drg_code_type, drg_code, drg_description,
        revenue_center_code, revenue_center_description, service_unit_quantity number,
        hcpcs_code, hcpcs_modifier_1, hcpcs_modifier_2, hcpcs_modifier_3, hcpcs_modifier_4,
        hcpcs_modifier_5, rendering_npi, rendering_tin, rendering_name,
        billing_npi, billing_tin, billing_name, facility_npi, facility_name,
        paid_date date, paid_amount number, allowed_amount number, charge_amount number,
        coinsurance_amount number, copayment_amount number, deductible_amount number,
        total_cost_amount number, in_network_flag int, data_source,
        service_category_1, service_category_2, service_category_3,
        enrollment_flag int, last_run_ts time
    """,
    "pharmacy_claim": """
        pharmacy_claim_id, claim_id, claim_line_number int, person_id, member_id, payer, plan,
        member_month_id, data_source, ndc_code, paid_amount number, allowed_amount number,
        prescribing_provider_id, prescribing_provider_name,
        dispensing_provider_id, dispensing_provider_name,
        paid_date date, dispensing_date date, days_supply int, quantity number,
        last_run_ts time
    """,
    "member_month": f"""
        person_id, data_source, member_month_id, member_id, year_month, payer, plan,
        {", ".join(ATTRIBUTION)}, last_run_ts time
    """,
    "cost": f"""
        person_id, member_id, year_month, payer, plan, data_source,
        {", ".join(ATTRIBUTION)},
        {", ".join(f"{m} number" for m in COST_MEASURES)}, last_run_ts time
    """,
    "practitioner": "npi, specialty, practitioner_id, data_source",
    "risk_factors": """
        person_id, payer, data_source, factor_type, risk_factor_description,
        coefficient number, model_version, payment_year int
    """,
    "risk_scores": """
        person_id, payer, data_source, v24_risk_score number, v28_risk_score number,
        blended_risk_score number, normalized_risk_score number, payment_risk_score number,
        payment_risk_score_weighted_by_months number, member_months int, payment_year int
    """,
    "risk_scores_monthly": """
        person_id, payer, data_source, risk_model_code, enrollment_status, payment_year int,
        collection_start_date date, collection_end_date date, normalized_risk_score number
    """,
    "hcc_suspects": """
        person_id, payer, data_source, model_version, hcc_code, hcc_description,
        reason, contributing_factor, latest_suspect_date date
    """,
    "quality_measures": """
        person_id, data_source, denominator_flag int, numerator_flag int, exclusion_flag int,
        performance_flag int, evidence_date date, evidence_value, exclusion_date date,
        exclusion_reason, performance_period_begin date, performance_period_end date,
        measure_id, measure_name, measure_version
    """,
    "augmented_admissions": "encounter_id, data_source",
    "readmissions": """
        encounter_id, index_admission_flag int, had_readmission_flag int, planned_flag int,
        readmit_30_flag int, unplanned_readmit_30_flag int, readmission_encounter_id,
        days_to_readmit int, readmission_admit_date date, readmission_discharge_date date,
        readmission_discharge_disposition_code, readmission_facility,
        readmission_drg_code_type, readmission_drg, readmission_length_of_stay int,
        readmission_index_admission_flag int, readmission_planned_flag int,
        readmission_specialty_cohort, readmission_died_flag int, readmission_diagnosis_ccs,
        data_source
    """,
    "pqi_summary": "pqi_number, pqi_name, encounter_id, data_source",
    "ed_classification": """
        encounter_id, person_id, data_source,
        ed_classification_order loose, ed_classification_description
    """,
    "calendar": """
        full_date date, year int, month int, day int, month_name, day_of_week_number int,
        day_of_week_name, week_of_year int, day_of_year int, year_month,
        first_day_of_month date, last_day_of_month date, year_month_int int
    """,
    "service_categories": "service_category_1, service_category_2, service_category_3",
    "diagnosis_categories": """
        code, ccsr_parent_category, ccsr_category, ccsr_category_description,
        ccsr_category_rank int
    """,
    "drug_packages": "ndc11, drug_id, drug_name, is_brand loose",
    "drugs": "drug_id, drug_name, is_brand loose",
    "drug_classes": "drug_id, atc_1_name, atc_2_name, atc_3_name, atc_4_name",
    "encounter_group_keys": "encounter_group, encounter_group_sk",
    "encounter_type_keys": "encounter_type, encounter_type_sk, encounter_group_sk",
}

# Inputs whose columns beyond the contract are kept (all upstream columns are passed on).
OPEN_CONTRACTS = frozenset({"augmented_admissions", "encounter_group_keys"})

_TYPES = {
    "text": T.StringType(),
    "int": T.IntegerType(),
    "number": T.DecimalType(28, 6),
    "date": T.DateType(),
    "time": T.TimestampType(),
    "loose": T.StringType(),
}
_ACCEPTED = {
    "text": (T.StringType, T.VarcharType, T.CharType),
    "int": (T.IntegralType, T.DecimalType),
    "number": (T.NumericType,),
    "date": (T.DateType,),
    "time": (T.TimestampType, T.TimestampNTZType),
    "loose": (T.StringType, T.VarcharType, T.CharType, T.BooleanType, T.IntegralType),
}


class ContractError(ValueError):
    """An input relation lacks a column, or has it with another kind of type."""


def _parse(text: str) -> dict[str, str]:
    columns = {}
    for item in text.split(","):
        name, *kind = item.split()
        columns[name] = kind[0] if kind else "text"
    return columns


CONTRACTS: dict[str, dict[str, str]] = {name: _parse(text) for name, text in _COLUMNS.items()}


def schema(name: str) -> T.StructType:
    """Nominal Spark schema of an input, for readers of untyped files and for tests."""
    return T.StructType(
        [T.StructField(column, _TYPES[kind]) for column, kind in CONTRACTS[name].items()]
    )


def conform(name: str, frame: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Project ``frame`` to the columns of the contract; raise on missing or mistyped ones.

    Amounts of any numeric type become decimals, so that sums do not depend on task order.
    """
    contract = CONTRACTS[name]
    wanted = list(columns) if columns is not None else list(contract)
    actual = {field.name: field.dataType for field in frame.schema.fields}
    problems = []
    for column in wanted:
        if column not in actual:
            problems.append(f"{column} is missing")
        elif not isinstance(actual[column], (*_ACCEPTED[contract[column]], T.NullType)):
            problems.append(
                f"{column} is {actual[column].simpleString()}, expected {contract[column]}"
            )
    if problems:
        raise ContractError(f"{name}: " + "; ".join(problems))
    inexact = {
        column: frame[column].cast(_TYPES["number"])
        for column in wanted
        if contract[column] == "number" and isinstance(actual[column], (T.DoubleType, T.FloatType))
    }
    exact = frame.withColumns(inexact) if inexact else frame
    if name in OPEN_CONTRACTS:
        return exact
    return only(exact, wanted)
