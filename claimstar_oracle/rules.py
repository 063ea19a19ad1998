"""Which rules the published tables must keep, listed apart from the package's own list."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    check: str
    table: str
    columns: tuple[str, ...]
    parent: tuple[str, str] | None = None
    values: tuple[str, ...] = ()


# Fixed values. Table, then columns: each column a rule of its own (not null, unique), or all of
# them one rule (combinations); of relationships also the parent table, whose key has the same name.
NOT_NULL = """
dim_data_source data_source_sk data_source
dim_date full_date
dim_encounter_group encounter_group_sk encounter_group
dim_encounter_provider encounter_id data_source
dim_encounter_type encounter_type_sk encounter_type
dim_member person_sk
dim_member_months member_month_id
dim_service_category service_category_sk
fact_admissions encounter_id data_source
fact_claims medical_claim_id service_category_sk
fact_hcc_gaps data_source
fact_member_months member_month_id
fact_pharmacy_claims pharmacy_claim_id
fact_quality_measures data_source
fact_risk_factors data_source
fact_risk_scores data_source
member_month_risk member_month_id data_source
encounter_group_keys encounter_group encounter_group_sk
encounter_type_keys encounter_type encounter_type_sk encounter_group_sk
"""
UNIQUE = """
dim_data_source data_source_sk data_source
dim_date full_date
dim_encounter_group encounter_group_sk encounter_group
dim_encounter_type encounter_type_sk encounter_type
dim_member person_sk
dim_member_months member_month_id
dim_service_category service_category_sk
fact_member_months member_month_id
encounter_group_keys encounter_group encounter_group_sk
encounter_type_keys encounter_type encounter_type_sk
dim_member_months member_month_sk
fact_member_months member_month_sk
"""
UNIQUE_COMBINATION = """
dim_encounter_provider encounter_id data_source
dim_member person_id data_source
fact_admissions encounter_id data_source pqi_number
fact_claims medical_claim_id data_source
fact_ed_visits encounter_id data_source
fact_encounter_service_bridge encounter_id data_source service_category_sk
fact_encounters encounter_id data_source
fact_hcc_gaps person_id payer data_source model_version hcc_code
fact_pharmacy_claims pharmacy_claim_id data_source
fact_quality_measures person_id data_source measure_id measure_version performance_period_begin performance_period_end
fact_risk_factors person_id payer data_source factor_type risk_factor_description model_version payment_year
fact_risk_scores person_id payer data_source payment_year
readmissions encounter_id data_source
encounter_enrichment encounter_id data_source
member_month_risk member_month_id data_source
"""
RELATIONSHIP = """
dim_encounter_type encounter_group_sk dim_encounter_group
fact_claims member_month_id dim_member_months
fact_claims service_category_sk dim_service_category
fact_encounters encounter_group_sk dim_encounter_group
fact_encounters encounter_type_sk dim_encounter_type
fact_member_months member_month_id dim_member_months
fact_pharmacy_claims member_month_id dim_member_months
encounter_type_keys encounter_group_sk encounter_group_keys
"""
ACCEPTED_VALUES = "fact_pharmacy_claims brand_vs_generic brand generic"


def rules_of(check: str) -> list[Rule]:
    if check == "accepted_values":
        table, column, *values = ACCEPTED_VALUES.split()
        return [Rule(check, table, (column,), values=tuple(values))]
    lists = {
        "not_null": NOT_NULL,
        "unique": UNIQUE,
        "unique_combination": UNIQUE_COMBINATION,
        "relationship": RELATIONSHIP,
    }
    rules = []
    for line in lists[check].strip().splitlines():
        table, *columns = line.split()
        if check == "relationship":
            column, parent = columns
            rules.append(Rule(check, table, (column,), parent=(parent, column)))
        elif check == "unique_combination":
            rules.append(Rule(check, table, tuple(columns)))
        else:
            rules += [Rule(check, table, (column,)) for column in columns]
    return rules
