"""SQL of the published tables, checks and mappings, written independently of the Spark code.

Each entry names the relations it reads; they become common table expressions in front of it.
Staged inputs come from the portable test-data bindings.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from claimstar.sources.contracts import ATTRIBUTION, CONTRACTS, COST_MEASURES
from claimstar.sources.inputs import PASSES_STAMP, UNSTAMPED
from claimstar.sources.mapping import MAPPINGS, raw_columns
from claimstar_oracle.binding import BINDINGS, RAW_BINDINGS, bind_sql
from claimstar_oracle.published import PUBLISHED, kind
from claimstar_oracle.rules import Rule, rules_of

RUN_TS = "2025-01-01 00:00:00"
_STAMP = f"cast('{RUN_TS}' as timestamp)"


@dataclass(frozen=True)
class Relation:
    needs: tuple[str, ...]
    sql: str


def _staged(name: str) -> Relation:
    bound = bind_sql(BINDINGS[name])
    columns = ", ".join(f'"{c}"' for c in CONTRACTS[name])
    if name == "member_month":
        columns += ", left(year_month, 4) as year_nbr"
    if name not in PASSES_STAMP and name not in UNSTAMPED:
        columns += f", {_STAMP} as last_run_ts"
    distinct = "distinct " if name == "eligibility" else ""
    where = " where encounter_source_type = 'claim'" if name == "encounter" else ""
    return Relation((), f"select {distinct}{columns} from ({bound}) b{where}")


def _published(table: str, **computed: str) -> str:
    """The published column list; computed columns get their expression."""
    unused = set(computed) - set(PUBLISHED[table])
    assert not unused, unused
    return ", ".join(
        f'{computed[c]} as "{c}"' if c in computed else f'"{c}"' for c in PUBLISHED[table]
    )


_PERSON_SOURCE = "person_id || '|' || data_source"


def _month(day: str) -> str:
    return f"strftime({day}, '%Y%m')"


def _sk(*columns: str) -> str:
    parts = [f"coalesce({c}, '_dbt_utils_surrogate_key_null_')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


_LEVELS = ("service_category_1", "service_category_2", "service_category_3")
_LEVEL_LIST = ", ".join(_LEVELS)

_TABLES: dict[str, Relation] = {
    "dim_data_source": Relation(
        ("eligibility", "medical_claim", "pharmacy_claim"),
        f"""select {_published("dim_data_source", data_source_sk=_sk("data_source"),
                               last_run_ts=_STAMP)}
        from (select data_source from eligibility union select data_source from medical_claim
              union select data_source from pharmacy_claim)""",
    ),
    "dim_date": Relation(
        ("calendar", "medical_claim"),
        f"""select distinct {_published("dim_date")} from calendar
        where full_date >= (select min(claim_start_date) from medical_claim)
          and full_date <= (select max(claim_start_date) from medical_claim)""",
    ),
    "dim_encounter_group": Relation(
        ("encounter_group_keys",),
        f"""select {_published("dim_encounter_group", last_run_ts=_STAMP)}
        from encounter_group_keys""",
    ),
    "dim_encounter_type": Relation(
        ("encounter_type_keys",),
        f"""select {_published("dim_encounter_type", last_run_ts=_STAMP)}
        from encounter_type_keys""",
    ),
    "dim_encounter_provider": Relation(
        ("medical_claim", "practitioner", "dim_data_source"),
        f"""select {_published("dim_encounter_provider", primary_provider_id="rendering_npi")}
        from (
            select c.encounter_id, c.data_source, c.rendering_npi, s.specialty,
                   sum(c.paid_amount) as paid, max(c.last_run_ts) as last_run_ts
            from medical_claim c
            join dim_data_source d on d.data_source = c.data_source
            left join (
                select npi, data_source, specialty from practitioner
                qualify row_number() over (
                    partition by npi, data_source
                    order by practitioner_id nulls last, specialty nulls last) = 1
            ) s on s.npi = c.rendering_npi and s.data_source = c.data_source
            group by 1, 2, 3, 4
        )
        qualify row_number() over (
            partition by encounter_id, data_source
            order by coalesce(paid, 0) desc, rendering_npi asc nulls last,
                     coalesce(specialty, '') asc, last_run_ts desc nulls last) = 1""",
    ),
    "dim_member": Relation(
        ("patient",), f"select {_published('dim_member', person_sk=_PERSON_SOURCE)} from patient"
    ),
    "dim_member_months": Relation(
        ("member_month",),
        f"""select {_published("dim_member_months", patient_source_key=_PERSON_SOURCE,
                               member_month_sk="person_id || '|' || year_month")}
        from member_month""",
    ),
    "dim_service_category": Relation(
        ("service_categories",),
        f"""select {_published("dim_service_category", service_category_sk=_sk(*_LEVELS),
                               last_run_ts=_STAMP)}
        from (select distinct {_LEVEL_LIST} from service_categories)""",
    ),
    "fact_encounters": Relation(
        ("encounter", "dim_encounter_group", "dim_encounter_type"),
        f"""select {_published(
            "fact_encounters", patient_source_key=_PERSON_SOURCE,
            member_month_sk=f"person_id || '|' || {_month('encounter_start_date')}",
            year_month=_month('encounter_start_date'), last_run_ts="encounter.last_run_ts",
            encounter_group_sk="g.encounter_group_sk")}
        from encounter
        join dim_encounter_group g on g.encounter_group = encounter.encounter_group
        join dim_encounter_type t on t.encounter_type = encounter.encounter_type""",
    ),
    "encounter_enrichment": Relation(
        ("fact_encounters", "dim_encounter_provider", "diagnosis_categories"),
        f"""select {_published("encounter_enrichment", encounter_id="e.encounter_id",
                               data_source="e.data_source")}
        from fact_encounters e
        left join dim_encounter_provider p
          on p.encounter_id = e.encounter_id and p.data_source = e.data_source
        left join diagnosis_categories c
          on c.code = e.primary_diagnosis_code
         and lower(e.primary_diagnosis_code_type) = 'icd-10-cm' and c.ccsr_category_rank = 1""",
    ),
    "fact_claims": Relation(
        ("medical_claim", "dim_service_category", "encounter_enrichment", "dim_data_source"),
        f"""select {_published(
            "fact_claims", patient_source_key=_PERSON_SOURCE,
            member_month_sk=f"person_id || '|' || {_month('claim_start_date')}",
            year_month=_month('claim_start_date'))}
        from (select * from medical_claim where enrollment_flag = 1) m
        join (select service_category_sk, {_LEVEL_LIST} from dim_service_category) sc
          using ({_LEVEL_LIST})
        join encounter_enrichment using (encounter_id, data_source)
        join (select data_source from dim_data_source) ds using (data_source)""",
    ),
    "fact_encounter_service_bridge": Relation(
        ("fact_claims",),
        f"""select distinct {_published("fact_encounter_service_bridge", last_run_ts=_STAMP)}
        from fact_claims""",
    ),
    "fact_admissions": Relation(
        ("augmented_admissions", "encounter", "readmissions", "pqi_summary"),
        f"""select {_published(
            "fact_admissions", encounter_id="e.encounter_id", data_source="e.data_source",
            patient_source_key="person_id || '|' || e.data_source",
            member_month_sk=f"person_id || '|' || {_month('encounter_start_date')}",
            admit_date="encounter_start_date", discharge_date="encounter_end_date",
            pqi_flag="cast(p.encounter_id is not null as integer)",
            last_run_ts="e.last_run_ts")}
        from augmented_admissions a
        join encounter e on (e.encounter_id, e.data_source) = (a.encounter_id, a.data_source)
        left join readmissions r
          on r.encounter_id = a.encounter_id and r.data_source = a.data_source
        left join pqi_summary p
          on p.encounter_id = a.encounter_id and p.data_source = a.data_source""",
    ),
    "fact_ed_visits": Relation(
        ("encounter", "ed_classification"),
        f"""select {_published(
            "fact_ed_visits", encounter_id="e.encounter_id", person_id="e.person_id",
            data_source="e.data_source", last_run_ts="e.last_run_ts",
            member_month_sk=f"e.person_id || '|' || {_month('encounter_start_date')}",
            ed_classification_order="coalesce(try_cast(k.ed_classification_order as int), 99)",
            ed_classification_description=(
                "coalesce(k.ed_classification_description, 'Unclassified')"),
            avoidable=(
                "coalesce(cast(try_cast(k.ed_classification_order as int) <= 3 as int), 0)"),
            avoidable_description=(
                "case when try_cast(k.ed_classification_order as int) <= 3"
                " then k.ed_classification_description end"))}
        from encounter e
        left join ed_classification k
          on k.encounter_id = e.encounter_id and k.data_source = e.data_source
        where e.encounter_type = 'emergency department'""",
    ),
    "fact_hcc_gaps": Relation(
        ("hcc_suspects",), f"select {_published('fact_hcc_gaps')} from hcc_suspects"
    ),
    "member_month_risk": Relation(
        ("member_month", "risk_scores_monthly"),
        f"""select {_published(
            "member_month_risk", data_source="mm.data_source",
            population_normalized_risk_score=(
                "case when pop.mean is not null and pop.mean <> 0"
                " then cast(normalized_risk_score as double) / pop.mean end"))}
        from member_month mm
        left join risk_scores_monthly r
          on r.person_id = mm.person_id and r.data_source = mm.data_source
         and {_month('r.collection_end_date')} = mm.year_month
         and r.payer is not distinct from mm.payer
        left join (
            select {_month('collection_end_date')} as risk_month, data_source,
                   cast(sum(normalized_risk_score) as double) / count(normalized_risk_score)
                       as mean
            from risk_scores_monthly group by 1, 2
        ) pop on pop.risk_month = mm.year_month and pop.data_source = mm.data_source""",
    ),
    "fact_member_months": Relation(
        ("member_month", "member_month_risk", "cost"),
        f"""select {_published(
            "fact_member_months",
            **{c: f"mm.{c}" for c in ("person_id", "member_id", "member_month_id", "year_month",
                                      "data_source", "payer", "plan", "last_run_ts")},
            member_month_sk="mm.person_id || '|' || mm.year_month", member_months="1",
            patient_source_key="mm.person_id || '|' || mm.data_source",
            total_year_months="cast(count(*) over covered as bigint)",
            month_allocation_factor="1.0 / count(*) over covered")}
        from member_month mm
        left join member_month_risk k
          on k.member_month_id = mm.member_month_id and k.data_source = mm.data_source
        left join cost c
          on c.person_id = mm.person_id and c.member_id = mm.member_id
         and c.year_month = mm.year_month and c.data_source = mm.data_source
         and c.payer is not distinct from mm.payer and c.plan is not distinct from mm.plan
        window covered as (partition by mm.person_id, mm.member_id, mm.payer, mm.plan,
                           mm.data_source, mm.year_nbr)""",
    ),
    "fact_pharmacy_claims": Relation(
        ("pharmacy_claim", "drug_packages", "drugs", "drug_classes", "practitioner"),
        f"""select {_published(
            "fact_pharmacy_claims", data_source="p.data_source",
            patient_source_key="person_id || '|' || p.data_source",
            ndc_description="k.drug_name", prescribing_specialty="s.specialty",
            cost_per_day="per_day", thirty_day_equivalent_cost="per_day * 30",
            specialty_tier="case when per_day * 30 >= 950 then 1 else 0 end",
            rxcui="k.drug_id", rxnorm_description="coalesce(d.drug_name, k.drug_name)",
            brand_name=(
                "case when lower(coalesce(d.is_brand, k.is_brand))"
                " in ('true', '1', 't', 'yes', 'y')"
                " then coalesce(d.drug_name, k.drug_name) end"),
            brand_vs_generic=(
                "case when lower(coalesce(d.is_brand, k.is_brand))"
                " in ('true', '1', 't', 'yes', 'y') then 'brand'"
                " when lower(coalesce(d.is_brand, k.is_brand))"
                " in ('false', '0', 'f', 'no', 'n') then 'generic' end"),
            ingredient_name="cast(null as varchar)")}
        from (
            select *, cast(paid_amount as double) / cast(nullif(days_supply, 0) as double)
                as per_day
            from pharmacy_claim
        ) p
        left join drug_packages k on k.ndc11 = p.ndc_code
        left join drugs d on d.drug_id = k.drug_id
        left join drug_classes a on a.drug_id = k.drug_id
        left join practitioner s
          on s.practitioner_id = p.prescribing_provider_id and s.data_source = p.data_source"""
        .replace('"last_run_ts"', 'p.last_run_ts as "last_run_ts"'),
    ),
    "fact_quality_measures": Relation(
        ("quality_measures",), f"select {_published('fact_quality_measures')} from quality_measures"
    ),
    "fact_risk_factors": Relation(
        ("risk_factors",), f"select {_published('fact_risk_factors')} from risk_factors"
    ),
    "fact_risk_scores": Relation(
        ("risk_scores",), f"select {_published('fact_risk_scores')} from risk_scores"
    ),
    "published_encounters": Relation(
        ("encounter", "dim_encounter_group", "dim_encounter_type"),
        """select e.encounter_id, e.data_source from encounter e
        where e.encounter_group in (select encounter_group from dim_encounter_group)
          and e.encounter_type in (select encounter_type from dim_encounter_type)""",
    ),
    "uncovered_encounter_groups": Relation(
        ("encounter", "dim_encounter_group"),
        """select distinct encounter_group from encounter
        where encounter_group is not null
          and encounter_group not in (select encounter_group from dim_encounter_group)""",
    ),
    "uncovered_encounter_types": Relation(
        ("encounter", "dim_encounter_type"),
        """select distinct encounter_type from encounter
        where encounter_type is not null
          and encounter_type not in (select encounter_type from dim_encounter_type)""",
    ),
    "missing_fixed_keys": Relation(
        ("dim_encounter_type",),
        """select * from (values ('inpatient long term acute care', '32', '1'))
            t(encounter_type, encounter_type_sk, encounter_group_sk)
        where not exists (
            select 1 from dim_encounter_type d
            where d.encounter_type = t.encounter_type
              and d.encounter_type_sk = t.encounter_type_sk
              and d.encounter_group_sk = t.encounter_group_sk)""",
    ),
    "uncovered_service_categories": Relation(
        ("medical_claim", "published_encounters", "dim_data_source", "dim_service_category"),
        f"""select distinct {", ".join(f"m.{c}" for c in _LEVELS)} from medical_claim m
        join published_encounters e
          on e.encounter_id = m.encounter_id and e.data_source = m.data_source
        join dim_data_source d on d.data_source = m.data_source
        left join dim_service_category c
          on {" and ".join(f"c.{c} = m.{c}" for c in _LEVELS)}
        where m.enrollment_flag = 1 and c.service_category_sk is null
          and {" and ".join(f"m.{c} is not null" for c in _LEVELS)}""",
    ),
}


def relation(name: str) -> Relation:
    return _TABLES[name] if name in _TABLES else _staged(name)


def _ordered(needs: Iterable[str], seen: list[str]) -> list[str]:
    for name in needs:
        if name not in seen:
            _ordered(relation(name).needs, seen)
            seen.append(name)
    return seen


def _with(needs: Iterable[str], body: str) -> str:
    ctes = [f"{name} as ({relation(name).sql})" for name in _ordered(needs, [])]
    return (f"with {', '.join(ctes)} " if ctes else "") + body


def portable(columns: Iterable[str], body: str) -> str:
    """Dates and timestamps as text, numbers of the inputs as double rounded to six places."""
    items = []
    for column in columns:
        if kind(column) in ("date", "time"):
            items.append(f'cast("{column}" as varchar) as "{column}"')
        elif kind(column) in ("int", "number"):
            items.append(f'round(cast("{column}" as double), 6) as "{column}"')
        else:
            items.append(f'"{column}"')
    return f"select {', '.join(items)} from ({body}) result"


def table_sql(name: str) -> str:
    return _with([name], portable(PUBLISHED[name], f"select * from {name}"))


def input_columns(name: str) -> list[str]:
    columns = list(CONTRACTS[name])
    if name == "member_month":
        columns.append("year_nbr")
    if name not in PASSES_STAMP and name not in UNSTAMPED:
        columns.append("last_run_ts")
    return columns


def input_sql(name: str) -> str:
    return _with([name], portable(input_columns(name), f"select * from {name}"))


def rows_sql(name: str) -> str:
    """All rows of a relation without numbers or dates."""
    return _with([name], f"select * from {name}")


def count_sql(check: str, name: str) -> str:
    """Number of rows of a relation, as the result of a check."""
    counted = f"select '{check}' as check_name, count(*) as violations from {name}"
    return _with([name], counted)


def _rule_sql(rule: Rule) -> str:
    names = ",".join(rule.columns)
    first = f'"{rule.columns[0]}"'
    table = rule.table
    if rule.check == "not_null":
        counted = f"(select count(*) from {table} where {first} is null)"
    elif rule.check in ("unique", "unique_combination"):
        keys = ", ".join(f'"{c}"' for c in rule.columns)
        some = f"where {first} is not null" if rule.check == "unique" else ""
        counted = (
            f"(select count(*) from (select {keys} from {table} {some}"
            f" group by {keys} having count(*) > 1))"
        )
    elif rule.check == "relationship":
        parent, key = rule.parent
        counted = (
            f"(select count(*) from {table} c left join (select distinct {key} as k from"
            f" {parent}) p on p.k = c.{first} where c.{first} is not null and p.k is null)"
        )
    else:
        listed = ", ".join(f"'{v}'" for v in rule.values)
        counted = (
            f"(select count(distinct {first}) from {table} where {first} not in ({listed}))"
        )
    return (
        f"select '{rule.check}' as check_name, '{table}' as table_name,"
        f" '{names}' as column_names, cast({counted} as bigint) as violations"
    )


def _violations_sql(rule: Rule) -> str:
    keys = ", ".join(f'"{c}"' for c in rule.columns)
    text = ", ".join(f"coalesce(cast(\"{c}\" as varchar), '\\N')" for c in rule.columns)
    first = f'"{rule.columns[0]}"'
    having = ""
    if rule.check == "not_null":
        which = f"{first} is null"
    elif rule.check == "relationship":
        parent, key = rule.parent
        which = f"{first} is not null and {first} not in (select {key} from {parent} where {key} is not null)"
    elif rule.check == "accepted_values":
        which = f"{first} not in (" + ", ".join(f"'{v}'" for v in rule.values) + ")"
    else:
        which = f"{first} is not null" if rule.check == "unique" else "true"
        having = " having count(*) > 1"
    return (
        f"select '{rule.check}' as check_name, '{rule.table}' as table_name,"
        f" '{','.join(rule.columns)}' as column_names, concat_ws('|', {text}) as key,"
        f" count(*) as n_rows from {rule.table} where {which} group by {keys}{having}"
    )


def _all_rules(check: str, sql_of) -> str:
    rules = rules_of(check)
    needs = [name for r in rules for name in (r.table, *(r.parent[:1] if r.parent else ()))]
    return _with(dict.fromkeys(needs), " union all ".join(sql_of(r) for r in rules))


def rules_sql(check: str) -> str:
    """Number of violations of every rule of a kind."""
    return _all_rules(check, _rule_sql)


def violations_sql(check: str) -> str:
    """The violating keys of every rule of a kind."""
    return _all_rules(check, _violations_sql)


# Whole numbers among the mapped columns.
_WHOLE = ("claim_line_number", "days_supply")


def mapping_sql(name: str) -> str:
    """The mapped extract, dates and timestamps as text and amounts as double."""
    mapping = MAPPINGS[name]
    raw = RAW_BINDINGS[name]
    missing = set(raw_columns(name)) - set(raw.columns)
    assert not missing, missing
    special = {
        "appointment": {
            "type": "coalesce(type_description, type_code)",
            "status": "coalesce(status_description, status_code)",
        },
        "lab_result": {
            "source_abnormal_code": "source_abnormal_flag",
            "normalized_abnormal_code": "normalized_abnormal_flag",
        },
    }.get(name, {})
    if name in ("appointment", "location", "practitioner"):
        special = {**special, "ingest_datetime": "cast(null as timestamp)"}
    extension = {
        "eligibility": {
            "x_temp_record_origin": "concat('claims_', cast(person_id as varchar))",
            "x_temp_person_id": "person_id",
            "x_temp_first_name": "first_name",
        },
        "medical_claim": {"x_temp_claim_id": "claim_id", "x_temp_payer": "payer"},
        "patient": {"x_temp_record_origin": "concat('clinical_', cast(person_id as varchar))"},
        "pharmacy_claim": {"x_temp_ndc_code": "ndc_code"},
    }.get(name, {})
    columns = [*mapping.columns, *extension, *mapping.metadata]
    items = []
    for column in columns:
        text = special.get(column) or extension.get(column) or f'"{column}"'
        if column.endswith(("_date", "_datetime")) or "procedure_date" in column:
            text = f"cast({text} as varchar)"
        elif column.endswith(("_amount", "quantity")) or column in _WHOLE:
            text = f"cast({text} as double)"
        items.append(f'{text} as "{column}"')
    return f"select {', '.join(items)} from ({bind_sql(raw)}) raw"


assert set(COST_MEASURES) <= set(PUBLISHED["fact_member_months"])
assert set(ATTRIBUTION) <= set(PUBLISHED["dim_member_months"])
