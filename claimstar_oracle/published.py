"""Published columns of every table, in order, and the kinds that are compared as text or double."""

from __future__ import annotations

from claimstar.sources.contracts import CONTRACTS, COST_MEASURES, STAMP

_MEASURES = " ".join(COST_MEASURES)

# Fixed values.
_PUBLISHED = {
    "dim_data_source": "data_source_sk data_source last_run_ts",
    "dim_date": """full_date year month day month_name day_of_week_number day_of_week_name
        week_of_year day_of_year year_month first_day_of_month last_day_of_month year_month_int
        last_run_ts""",
    "dim_encounter_group": "encounter_group encounter_group_sk last_run_ts",
    "dim_encounter_provider": """encounter_id data_source primary_provider_id specialty
        last_run_ts""",
    "dim_encounter_type": "encounter_type encounter_type_sk encounter_group_sk last_run_ts",
    "dim_member": """person_id person_sk name_suffix first_name middle_name last_name sex race
        birth_date death_date death_flag address city state zip_code county latitude longitude
        phone email ethnicity data_source age age_group last_run_ts""",
    "dim_member_months": """person_id year_nbr year_month member_month_id member_id
        member_month_sk data_source patient_source_key payer plan payer_attributed_provider
        payer_attributed_provider_practice payer_attributed_provider_organization
        payer_attributed_provider_lob custom_attributed_provider
        custom_attributed_provider_practice custom_attributed_provider_organization
        custom_attributed_provider_lob default_attributed_provider
        default_attributed_provider_bucket default_attributed_provider_specialty
        last_run_ts""",
    "dim_service_category": """service_category_sk service_category_1 service_category_2
        service_category_3 last_run_ts""",
    "fact_admissions": """encounter_id person_id data_source member_month_sk patient_source_key
        index_admission_flag had_readmission_flag planned_flag readmit_30_flag
        unplanned_readmit_30_flag admit_date discharge_date length_of_stay admit_source_code
        admit_source_description admit_type_code admit_type_description
        discharge_disposition_code discharge_disposition_description attending_provider_id
        attending_provider_name drg_code_type drg_code drg_description readmission_encounter_id
        days_to_readmit readmission_admit_date readmission_discharge_date
        readmission_discharge_disposition_code readmission_facility readmission_drg_code_type
        readmission_drg readmission_length_of_stay readmission_index_admission_flag
        readmission_planned_flag readmission_specialty_cohort readmission_died_flag
        readmission_diagnosis_ccs pqi_flag pqi_number pqi_name paid_amount allowed_amount
        charge_amount claim_count inst_claim_count prof_claim_count last_run_ts""",
    "fact_claims": """medical_claim_id encounter_id encounter_group_sk encounter_type_sk
        primary_diagnosis_code_type primary_diagnosis_code primary_diagnosis_description
        primary_provider_id specialty ccsr_parent_category ccsr_category
        ccsr_category_description person_id member_id member_month_id patient_source_key
        member_month_sk year_month service_category_sk claim_id claim_line_number claim_type
        payer plan claim_start_date claim_end_date claim_line_start_date claim_line_end_date
        admission_date discharge_date admit_source_code admit_source_description admit_type_code
        admit_type_description discharge_disposition_code discharge_disposition_description
        place_of_service_code place_of_service_description bill_type_code bill_type_description
        drg_code_type drg_code drg_description revenue_center_code revenue_center_description
        service_unit_quantity hcpcs_code hcpcs_modifier_1 hcpcs_modifier_2 hcpcs_modifier_3
        hcpcs_modifier_4 hcpcs_modifier_5 rendering_npi rendering_tin rendering_name billing_npi
        billing_tin billing_name facility_npi facility_name paid_date paid_amount
        allowed_amount charge_amount coinsurance_amount copayment_amount deductible_amount
        total_cost_amount in_network_flag data_source last_run_ts""",
    "fact_ed_visits": """encounter_id person_id data_source member_month_sk
        ed_classification_order ed_classification_description avoidable avoidable_description
        paid_amount allowed_amount charge_amount claim_count inst_claim_count prof_claim_count
        last_run_ts""",
    "fact_encounter_service_bridge": """encounter_id data_source service_category_sk
        last_run_ts""",
    "fact_encounters": """encounter_id person_id data_source patient_source_key member_month_sk
        year_month encounter_group_sk encounter_type_sk encounter_start_date encounter_end_date
        attending_provider_id attending_provider_name facility_npi facility_name facility_type
        observation_flag lab_flag dme_flag ambulance_flag pharmacy_flag ed_flag delivery_flag
        delivery_type newborn_flag nicu_flag primary_diagnosis_code_type primary_diagnosis_code
        primary_diagnosis_description paid_amount allowed_amount charge_amount claim_count
        inst_claim_count prof_claim_count source_model encounter_source_type last_run_ts""",
    "fact_hcc_gaps": """person_id payer data_source model_version hcc_code hcc_description
        reason contributing_factor latest_suspect_date last_run_ts""",
    "fact_member_months": f"""person_id member_id member_month_id year_nbr year_month
        member_month_sk member_months total_year_months month_allocation_factor data_source
        payer plan patient_source_key risk_model_code normalized_risk_score
        population_normalized_risk_score {_MEASURES} last_run_ts""",
    "fact_pharmacy_claims": """pharmacy_claim_id member_id payer plan member_month_id claim_id
        claim_line_number person_id data_source patient_source_key ndc_code ndc_description
        paid_amount allowed_amount prescribing_provider_id prescribing_provider_name
        prescribing_specialty dispensing_provider_id dispensing_provider_name paid_date
        dispensing_date days_supply cost_per_day thirty_day_equivalent_cost specialty_tier
        rxcui rxnorm_description brand_name brand_vs_generic ingredient_name atc_1_name
        atc_2_name atc_3_name atc_4_name last_run_ts""",
    "fact_quality_measures": """person_id data_source denominator_flag numerator_flag
        exclusion_flag performance_flag evidence_date evidence_value exclusion_date
        exclusion_reason performance_period_begin performance_period_end measure_id
        measure_name measure_version last_run_ts""",
    "fact_risk_factors": """person_id payer data_source factor_type risk_factor_description
        coefficient model_version payment_year last_run_ts""",
    "fact_risk_scores": """person_id payer data_source v24_risk_score v28_risk_score
        blended_risk_score normalized_risk_score payment_risk_score
        payment_risk_score_weighted_by_months member_months payment_year last_run_ts""",
    "encounter_enrichment": """encounter_id encounter_group_sk encounter_type_sk
        primary_diagnosis_code_type primary_diagnosis_code primary_diagnosis_description
        data_source primary_provider_id specialty ccsr_parent_category ccsr_category
        ccsr_category_description""",
    "member_month_risk": """member_month_id data_source risk_model_code normalized_risk_score
        population_normalized_risk_score""",
}
PUBLISHED: dict[str, list[str]] = {name: text.split() for name, text in _PUBLISHED.items()}

_KINDS = {c: kind for columns in CONTRACTS.values() for c, kind in columns.items()}
_KINDS |= {
    STAMP: "time",
    "admit_date": "date",
    "discharge_date": "date",
    "cost_per_day": "number",
    "thirty_day_equivalent_cost": "number",
    "month_allocation_factor": "number",
    "population_normalized_risk_score": "number",
}


def kind(column: str) -> str:
    return _KINDS.get(column, "text")
