"""Map raw extracts to the input layer: one projection per extract.

A mapping keeps the listed columns in order, fills the few derived ones (a renamed column, the
first non-null of two, a typed null) and adds extension columns, whose names start with ``x_``
and which pass through to the output next to the fixed columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXTENSION_PREFIX = "x_"


@dataclass(frozen=True)
class InputMapping:
    columns: tuple[str, ...]
    metadata: tuple[str, ...] = ("ingest_datetime", "data_source")
    renamed: Mapping[str, str] = field(default_factory=dict)
    first_of: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    absent: Mapping[str, str] = field(default_factory=dict)
    extensions: Mapping[str, str] = field(default_factory=dict)
    needs: tuple[str, ...] = ("clinical",)


def _names(text: str) -> tuple[str, ...]:
    return tuple(text.split())


def _numbered(stem: str, count: int = 25) -> str:
    return " ".join(f"{stem}_{i}" for i in range(1, count + 1))


_NO_INGEST_TIME = {"ingest_datetime": "timestamp"}
_CLAIM_METADATA = ("data_source", "file_date", "file_name", "ingest_datetime")

# The columns of each input-layer table, in order.
MAPPINGS: dict[str, InputMapping] = {
    "appointment": InputMapping(
        _names(
            """appointment_id person_id patient_id encounter_id start_datetime end_datetime
            duration location_id practitioner_id type status reason cancellation_reason"""
        ),
        first_of={
            "type": ("type_description", "type_code"),
            "status": ("status_description", "status_code"),
        },
        absent=_NO_INGEST_TIME,
    ),
    "condition": InputMapping(
        _names(
            """source_condition_id person_id patient_id encounter_id recorded_date onset_date
            resolved_date status condition_type code_system source_code source_description
            condition_rank present_on_admit_code"""
        )
    ),
    "eligibility": InputMapping(
        _names(
            """person_id member_id subscriber_id subscriber_relation enrollment_start_date
            enrollment_end_date payer payer_type plan first_name middle_name last_name
            name_suffix social_security_number address city state zip_code phone email
            ethnicity sex race birth_date death_date death_flag
            original_reason_entitlement_code dual_status_code medicare_status_code
            enrollment_status hospice_flag institutional_snp_flag medicaid_indicator
            long_term_institutional_flag part_d_raf_type low_income_subsidy_indicator
            metal_level csr_indicator enrollment_duration_months esrd_status
            transplant_duration_months group_id group_name"""
        ),
        metadata=("file_date", "file_name", "ingest_datetime", "data_source"),
        extensions={
            "x_temp_record_origin": "'claims_' || cast(person_id as string)",
            "x_temp_person_id": "person_id",
            "x_temp_first_name": "first_name",
        },
        needs=("claims",),
    ),
    "encounter": InputMapping(
        _names(
            """encounter_id person_id patient_id encounter_type encounter_start_date
            encounter_end_date admit_source_code admit_type_code discharge_disposition_code
            attending_provider_id attending_provider_name facility_npi facility_name
            primary_diagnosis_code_type primary_diagnosis_code drg_code_type drg_code
            paid_amount allowed_amount charge_amount"""
        )
    ),
    "immunization": InputMapping(
        _names(
            """immunization_id person_id patient_id encounter_id source_code_type source_code
            source_description status status_reason occurrence_date source_dose lot_number
            body_site route location_id practitioner_id"""
        )
    ),
    "lab_result": InputMapping(
        _names(
            """lab_result_id person_id patient_id encounter_id accession_number
            source_order_type source_order_code source_order_description
            source_component_type source_component_code source_component_description status
            result result_datetime collection_datetime source_units normalized_units
            source_reference_range_low source_reference_range_high
            normalized_reference_range_low normalized_reference_range_high
            source_abnormal_code normalized_abnormal_code specimen ordering_practitioner_id"""
        ),
        renamed={
            "source_abnormal_code": "source_abnormal_flag",
            "normalized_abnormal_code": "normalized_abnormal_flag",
        },
    ),
    "location": InputMapping(
        _names(
            """location_id npi name facility_type parent_organization address city state
            zip_code latitude longitude"""
        ),
        absent=_NO_INGEST_TIME,
    ),
    "medical_claim": InputMapping(
        _names(
            f"""claim_id claim_line_number claim_type person_id member_id payer plan
            claim_start_date claim_end_date claim_line_start_date claim_line_end_date
            admission_date discharge_date admit_source_code admit_type_code
            discharge_disposition_code place_of_service_code bill_type_code drg_code_type
            drg_code revenue_center_code service_unit_quantity hcpcs_code
            {_numbered("hcpcs_modifier", 5)} rendering_npi rendering_tin billing_npi
            billing_tin facility_npi paid_date paid_amount allowed_amount charge_amount
            coinsurance_amount copayment_amount deductible_amount total_cost_amount
            diagnosis_code_type {_numbered("diagnosis_code")} {_numbered("diagnosis_poa")}
            procedure_code_type {_numbered("procedure_code")} {_numbered("procedure_date")}
            in_network_flag"""
        ),
        metadata=_CLAIM_METADATA,
        extensions={"x_temp_claim_id": "claim_id", "x_temp_payer": "payer"},
        needs=("claims",),
    ),
    "medication": InputMapping(
        _names(
            """medication_id person_id patient_id encounter_id dispensing_date
            prescribing_date source_code_type source_code source_description ndc_code
            rxnorm_code atc_code route strength quantity quantity_unit days_supply
            practitioner_id"""
        )
    ),
    "observation": InputMapping(
        _names(
            """observation_id person_id patient_id encounter_id panel_id observation_date
            observation_type source_code_type source_code source_description result
            source_units normalized_units source_reference_range_low
            source_reference_range_high normalized_reference_range_low
            normalized_reference_range_high"""
        )
    ),
    "patient": InputMapping(
        _names(
            """person_id patient_id first_name middle_name last_name name_suffix sex race
            ethnicity birth_date death_date death_flag social_security_number address city
            state zip_code county latitude longitude phone email"""
        ),
        extensions={"x_temp_record_origin": "'clinical_' || cast(person_id as string)"},
    ),
    "pharmacy_claim": InputMapping(
        _names(
            """claim_id claim_line_number person_id member_id payer plan
            prescribing_provider_npi dispensing_provider_npi dispensing_date ndc_code
            quantity days_supply refills paid_date paid_amount allowed_amount charge_amount
            coinsurance_amount copayment_amount deductible_amount in_network_flag"""
        ),
        metadata=_CLAIM_METADATA,
        extensions={"x_temp_ndc_code": "ndc_code"},
        needs=("claims",),
    ),
    "practitioner": InputMapping(
        _names(
            """practitioner_id npi first_name last_name practice_affiliation specialty
            sub_specialty"""
        ),
        absent=_NO_INGEST_TIME,
    ),
    "procedure": InputMapping(
        _names(
            f"""source_procedure_id person_id patient_id encounter_id procedure_date
            code_system source_code source_description {_numbered("modifier", 5)}
            practitioner_id"""
        )
    ),
    "provider_attribution": InputMapping(
        _names(
            """person_id member_id year_month payer plan payer_attributed_provider
            payer_attributed_provider_practice payer_attributed_provider_organization
            payer_attributed_provider_lob custom_attributed_provider
            custom_attributed_provider_practice custom_attributed_provider_organization
            custom_attributed_provider_lob"""
        ),
        metadata=("file_name", "ingest_datetime", "data_source"),
        needs=("provider_attribution", "claims"),
    ),
}


def enabled_mappings(
    claims: bool = False, clinical: bool = False, provider_attribution: bool = False
) -> tuple[str, ...]:
    """Names of the mappings whose domains are all switched on."""
    on = {"claims": claims, "clinical": clinical, "provider_attribution": provider_attribution}
    return tuple(n for n, mapping in MAPPINGS.items() if all(on[d] for d in mapping.needs))


def raw_columns(name: str) -> tuple[str, ...]:
    """Columns a raw extract must have, in the order in which the mapping reads them."""
    mapping = MAPPINGS[name]
    needed: list[str] = []
    for column in (*mapping.columns, *mapping.metadata):
        if column in mapping.first_of:
            needed += mapping.first_of[column]
        elif column not in mapping.absent:
            needed.append(mapping.renamed.get(column, column))
    return tuple(needed)


def map_input(
    name: str, raw: DataFrame, extensions: Mapping[str, Column] | None = None
) -> DataFrame:
    """Project a raw extract to its input-layer table.

    ``extensions`` replaces the extension columns of the mapping; names must start with ``x_``.
    """
    mapping = MAPPINGS[name]

    def fixed(column: str) -> Column:
        if column in mapping.absent:
            return F.lit(None).cast(mapping.absent[column]).alias(column)
        if column in mapping.first_of:
            return F.coalesce(*mapping.first_of[column]).alias(column)
        return F.col(mapping.renamed.get(column, column)).alias(column)

    if extensions is None:
        extensions = {column: F.expr(text) for column, text in mapping.extensions.items()}
    wrong = [column for column in extensions if not column.startswith(EXTENSION_PREFIX)]
    if wrong:
        raise ValueError(f"extension columns must start with {EXTENSION_PREFIX}: {wrong}")
    return raw.select(
        *[fixed(column) for column in mapping.columns],
        *[column.alias(alias) for alias, column in extensions.items()],
        *[fixed(column) for column in mapping.metadata],
    )
