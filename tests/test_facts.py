"""Facts and intermediates: source scoping, null rules, edge values, grain."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from conftest import RUN_TS, rows
from pyspark.sql import functions as F

from claimstar.operators import dims, enrich, facts
from claimstar.sources.inputs import stage


def groups(given):
    return dims.encounter_group(
        given("encounter_group_keys", {"encounter_group": "inpatient", "encounter_group_sk": "1"}),
        RUN_TS,
    )


def types(given):
    return dims.encounter_type(
        given(
            "encounter_type_keys",
            {"encounter_type": "stay", "encounter_type_sk": "7", "encounter_group_sk": "99"},
        ),
        RUN_TS,
    )


def encounter(ident, source="a", **more):
    return {
        "encounter_id": ident,
        "data_source": source,
        "person_id": "p",
        "encounter_group": "inpatient",
        "encounter_type": "stay",
        "encounter_source_type": "claim",
        "encounter_start_date": "2024-02-10",
        **more,
    }


def test_encounters_need_mapped_labels_and_claims(given):
    frame = facts.encounters(
        given(
            "encounter",
            encounter("kept"),
            encounter("clinical", encounter_source_type="clinical"),
            encounter("no group", encounter_group=None),
            encounter("other type", encounter_type="unmapped"),
        ),
        groups(given),
        types(given),
    )
    columns = ("encounter_id", "encounter_group_sk", "encounter_type_sk", "member_month_sk")
    assert rows(frame, *columns) == [("kept", "1", "7", "p|202402")]


def test_diagnosis_category_only_for_icd_10(given, spark):
    encounters = spark.createDataFrame(
        [
            ("icd10", "g", "t", "ICD-10-CM", "K358", None, "a"),
            ("icd9", "g", "t", "icd-9-cm", "K358", None, "b"),
            ("untyped", "g", "t", None, "K358", None, "b"),
            ("uncoded", "g", "t", "icd-10-cm", None, None, "b"),
        ],
        "encounter_id string, encounter_group_sk string, encounter_type_sk string,"
        " primary_diagnosis_code_type string, primary_diagnosis_code string,"
        " primary_diagnosis_description string, data_source string",
    )
    providers = spark.createDataFrame(
        [("icd10", "a", "n1", "s1"), ("icd9", "a", "wrong", "wrong"), ("icd9", "b", "n2", "s2")],
        "encounter_id string, data_source string, primary_provider_id string, specialty string",
    )
    categories = given(
        "diagnosis_categories",
        {"code": "K358", "ccsr_category": "DIG008", "ccsr_category_rank": 1},
        {"code": "K358", "ccsr_category": "DIG009", "ccsr_category_rank": 2},
    )
    frame = enrich.encounter_enrichment(encounters, providers, categories)
    assert rows(frame, "encounter_id", "primary_provider_id", "ccsr_category") == [
        ("icd10", "n1", "DIG008"),
        ("icd9", "n2", None),
        ("uncoded", None, None),
        ("untyped", None, None),
    ]


def line(ident, enc="e", source="a", level_3="z", enrolled=1, **more):
    return {
        "medical_claim_id": ident,
        "encounter_id": enc,
        "data_source": source,
        "service_category_1": "x",
        "service_category_2": "y",
        "service_category_3": level_3,
        "enrollment_flag": enrolled,
        "person_id": "p",
        "claim_start_date": "2024-03-31",
        **more,
    }


@pytest.fixture
def claim_parts(given):
    """Lines, categories, enrichment and encounters; ids repeat across two sources."""
    lines = given(
        "medical_claim",
        line("both keys"),
        line("other source", source="b"),
        line("source without encounter", source="c"),
        line("same category again"),
        line("unenrolled", enrolled=0),
        line("enrollment unknown", enrolled=None),
        line("null level", level_3=None),
        line("unmapped level", level_3="q"),
        line("unknown encounter", enc="e9"),
        line("no encounter", enc=None),
        line("no source", source=None),
    )
    categories = dims.service_category(
        given(
            "service_categories",
            {"service_category_1": "x", "service_category_2": "y", "service_category_3": "z"},
            {"service_category_1": "x", "service_category_2": "y", "service_category_3": None},
        ),
        RUN_TS,
    )
    encounters = facts.encounters(
        given("encounter", encounter("e", "a"), encounter("e", "b"), encounter("unused", "c")),
        groups(given),
        types(given),
    )
    providers = dims.encounter_provider(lines, given("practitioner"))
    enrichment = enrich.encounter_enrichment(encounters, providers, given("diagnosis_categories"))
    return lines, categories, enrichment, encounters


def test_claims_keep_publishable_lines_of_their_own_source(claim_parts):
    lines, categories, enrichment, _ = claim_parts
    frame = facts.claims(lines, categories, enrichment)
    columns = ("medical_claim_id", "data_source", "year_month", "member_month_sk")
    assert rows(frame, *columns) == [
        ("both keys", "a", "202403", "p|202403"),
        ("other source", "b", "202403", "p|202403"),
        ("same category again", "a", "202403", "p|202403"),
    ]


def test_claims_with_a_given_source_dimension(claim_parts, spark):
    lines, categories, enrichment, _ = claim_parts
    sources = spark.createDataFrame([("a",), (None,)], "data_source string")
    frame = facts.claims(lines, categories, enrichment, sources)
    assert rows(frame, "medical_claim_id") == [("both keys",), ("same category again",)]


def test_bridge_from_links_equals_bridge_from_the_fact(claim_parts):
    lines, categories, enrichment, encounters = claim_parts
    fact = facts.claims(lines, categories, enrichment)
    links = facts.encounter_service_links(lines, categories, encounters)
    from_fact = facts.encounter_service_bridge(fact, RUN_TS)
    from_links = facts.encounter_service_bridge(links, RUN_TS)
    columns = from_fact.columns
    assert rows(from_links, *columns) == rows(from_fact, *columns)
    assert from_links.count() == 2


def test_admissions_fan_out_per_pqi_and_are_source_scoped(given):
    both = [{"encounter_id": "e", "data_source": s} for s in "ab"]
    frame = facts.admissions(
        given("augmented_admissions", *both, {"encounter_id": "clinical", "data_source": "a"}),
        given("encounter", encounter("e", "a"), encounter("e", "b"), encounter("x", "a")),
        given(
            "readmissions",
            {"encounter_id": "e", "data_source": "a", "readmission_encounter_id": "next"},
        ),
        given(
            "pqi_summary",
            {"encounter_id": "e", "data_source": "b", "pqi_number": "05"},
            {"encounter_id": "e", "data_source": "b", "pqi_number": "08"},
        ),
    )
    columns = ("encounter_id", "data_source", "readmission_encounter_id", "pqi_flag", "pqi_number")
    assert rows(frame, *columns) == [
        ("e", "a", "next", 0, None),
        ("e", "b", None, 1, "05"),
        ("e", "b", None, 1, "08"),
    ]


def test_readmissions_keep_rows_of_both_sources(given):
    staged = given(
        "readmissions",
        {"encounter_id": "e", "data_source": "a", "readmission_encounter_id": "r"},
        {"encounter_id": "e", "data_source": "b"},
    )
    assert rows(staged, "data_source", "readmission_encounter_id") == [("a", "r"), ("b", None)]


def test_ed_visits_order_default_and_avoidable(given):
    orders = {"e1": "1", "e3": "3", "e4": "4", "text": "n/a", "null": None, "part": "2.7"}
    encounters = [
        encounter(i, encounter_type="emergency department") for i in [*orders, "unmatched"]
    ]
    frame = facts.ed_visits(
        given("encounter", *encounters, encounter("stay only")),
        given(
            "ed_classification",
            *[
                {
                    "encounter_id": i,
                    "data_source": "a",
                    "ed_classification_order": order,
                    "ed_classification_description": f"class {i}",
                }
                for i, order in orders.items()
            ],
            {"encounter_id": "unmatched", "data_source": "b", "ed_classification_order": "1"},
        ),
    )
    columns = (
        "encounter_id",
        "ed_classification_order",
        "ed_classification_description",
        "avoidable",
        "avoidable_description",
    )
    assert rows(frame, *columns) == [
        ("e1", 1, "class e1", 1, "class e1"),
        ("e3", 3, "class e3", 1, "class e3"),
        ("e4", 4, "class e4", 0, None),
        ("null", 99, "class null", 0, None),
        ("part", 99, "class part", 0, None),
        ("text", 99, "class text", 0, None),
        ("unmatched", 99, "Unclassified", 0, None),
    ]


def score(person, source, value, payer="y", day="2025-01-31", model="community"):
    return {
        "person_id": person,
        "payer": payer,
        "data_source": source,
        "risk_model_code": model,
        "collection_end_date": day,
        "normalized_risk_score": value,
    }


def month(ident, person="p", source="a", payer="y", year_month="202501", **more):
    return {
        "member_month_id": ident,
        "person_id": person,
        "data_source": source,
        "payer": payer,
        "year_month": year_month,
        **more,
    }


def test_risk_is_scoped_by_source_and_relative_to_its_mean(given):
    frame = enrich.member_month_risk(
        given("member_month", month("a"), month("b", source="b")),
        given(
            "risk_scores_monthly",
            score("p", "a", 1.0),
            score("p", "b", 4.0, model="institutional"),
            score("other", "a", 3.0),
        ),
    )
    columns = (
        "member_month_id",
        "risk_model_code",
        "normalized_risk_score",
        "population_normalized_risk_score",
    )
    assert rows(frame, *columns) == [
        ("a", "community", Decimal("1.000000"), 0.5),
        ("b", "institutional", Decimal("4.000000"), 1.0),
    ]


def test_risk_null_rules(given):
    frame = enrich.member_month_risk(
        given(
            "member_month",
            month("null payer", payer=None, year_month="202502"),
            month("other payer", payer="z"),
            month("zero mean", source="z"),
            month("no score", person="q"),
        ),
        given(
            "risk_scores_monthly",
            score("p", "a", 2.0, payer=None, day="2025-02-28"),
            score("p", "a", None, day="2025-01-31", payer="z"),
            score("p", "z", 0),
            score("r", "a", 5.0),
        ),
    )
    columns = ("member_month_id", "normalized_risk_score", "population_normalized_risk_score")
    assert rows(frame, *columns) == [
        ("no score", None, None),
        ("null payer", Decimal("2.000000"), 1.0),
        ("other payer", None, None),
        ("zero mean", Decimal("0.000000"), None),
    ]


def test_member_months_cost_keys_and_allocation(given):
    months = [
        month(f"m{i}", member_id="1", plan=None, payer=None, year_month=f"2025{i:02d}")
        for i in range(1, 5)
    ]
    months += [
        month("next year", member_id="1", plan=None, payer=None, year_month="202601"),
        month("null member", member_id=None, plan="x"),
        month("other source", source="b", member_id="1", plan=None, payer=None),
    ]
    cost = [
        {"member_id": "1", "year_month": "202501", "total_paid": 10},
        {"member_id": "1", "year_month": "202502", "plan": "x", "total_paid": 20},
        {"member_id": None, "year_month": "202501", "payer": "y", "plan": "x", "total_paid": 30},
    ]
    cost = [{"person_id": "p", "data_source": "a", **c} for c in cost]
    frame = facts.member_months(
        given("member_month", *months), given("risk_scores_monthly"), given("cost", *cost)
    )
    columns = ("member_month_id", "total_paid", "total_year_months", "month_allocation_factor")
    assert rows(frame, *columns) == [
        ("m1", Decimal("10.000000"), 4, 0.25),
        ("m2", None, 4, 0.25),
        ("m3", None, 4, 0.25),
        ("m4", None, 4, 0.25),
        ("next year", None, 1, 1.0),
        ("null member", None, 1, 1.0),
        ("other source", None, 1, 1.0),
    ]


def test_month_allocation_against_brute_force(given):
    chance = random.Random(3)
    pick = lambda *values: chance.choice(values)
    months = [
        month(
            f"m{i}",
            person=pick("p", "q", None),
            source=pick("a", "b"),
            payer=pick("y", None),
            plan=pick("x", None),
            member_id=pick("1", None),
            year_month=pick("202412", "202501", "202502"),
        )
        for i in range(200)
    ]

    def year(m):
        names = ("person_id", "member_id", "payer", "plan", "data_source")
        return (*[m[n] for n in names], m["year_month"][:4])

    sizes = Counter(year(m) for m in months)
    frame = facts.member_months(
        given("member_month", *months), given("risk_scores_monthly"), given("cost")
    )
    expected = [(m["member_month_id"], sizes[year(m)], 1 / sizes[year(m)]) for m in months]
    columns = ("member_month_id", "total_year_months", "month_allocation_factor")
    assert rows(frame, *columns) == sorted(expected)


def test_months_count_the_rows_that_risk_and_cost_add(given):
    """Two risk rows, two cost rows, repeated and missing ids, against the joins written out."""
    months = [
        month("m1", member_id="1", payer="y", plan="x", year_month="202501"),
        month("m2", member_id="1", payer="y", plan="x", year_month="202502"),
        month(None, member_id="1", payer="y", plan="x", year_month="202503"),
        month("m4", member_id="1", payer="y", plan="x", year_month="202504"),
        month("m4", member_id="1", payer="y", plan="x", year_month="202505"),
    ]
    score = {"person_id": "p", "data_source": "a", "payer": "y", "normalized_risk_score": 1}
    risk = [
        {**score, "collection_end_date": f"2025-{m[4:]}-28", "risk_model_code": code}
        for m, code in [("202501", "a"), ("202501", "b"), ("202503", "c"), ("202504", "d")]
    ]
    cost = [
        {"person_id": "p", "member_id": "1", "data_source": "a", "payer": "y", "plan": "x",
         "year_month": m, "total_paid": paid}
        for m, paid in [("202502", 1), ("202502", 2), ("202503", 3)]
    ]
    frame = facts.member_months(
        given("member_month", *months),
        given("risk_scores_monthly", *risk),
        given("cost", *cost),
    )
    codes = {m: [r["risk_model_code"] for r in risk if r["collection_end_date"][5:7] == f"{m:02}"] or [None] for m in range(1, 6)}
    by_id = {}
    for m in months:
        by_id.setdefault(m["member_month_id"], []).extend(codes[int(m["year_month"][4:])])
    expected = []
    for m in months:
        paid = [c["total_paid"] for c in cost if c["year_month"] == m["year_month"]] or [None]
        found = by_id[m["member_month_id"]] if m["member_month_id"] else [None]
        expected += [(m["year_month"], k, p) for k in found for p in paid]
    got = frame.select("year_month", "risk_model_code", "total_paid").collect()
    plain = sorted((a, b or "", int(c or 0)) for a, b, c in got)
    assert plain == sorted((a, b or "", c or 0) for a, b, c in expected)
    totals = frame.select("total_year_months", "month_allocation_factor").distinct().collect()
    assert [tuple(t) for t in totals] == [(len(expected), 1 / len(expected))]


def pharmacy(given, claims, packages=(), drugs=(), classes=(), practitioners=(), **more):
    return facts.pharmacy_claims(
        given("pharmacy_claim", *claims),
        given("drug_packages", *packages),
        given("drugs", *drugs),
        given("drug_classes", *classes),
        given("practitioner", *practitioners),
        **more,
    )


def test_pharmacy_drug_enrichment(given):
    claims = [
        {
            "pharmacy_claim_id": "brand",
            "data_source": "a",
            "ndc_code": "1",
            "prescribing_provider_id": "d",
        },
        {
            "pharmacy_claim_id": "generic",
            "data_source": "b",
            "ndc_code": "2",
            "prescribing_provider_id": "d",
        },
        {"pharmacy_claim_id": "unmatched", "data_source": "a", "ndc_code": "9"},
        {"pharmacy_claim_id": "package only", "data_source": "a", "ndc_code": "3"},
    ]
    packages = [
        {"ndc11": "1", "drug_id": "x", "drug_name": "package brand", "is_brand": "false"},
        {"ndc11": "2", "drug_id": "y", "drug_name": "package generic", "is_brand": "true"},
        {"ndc11": "3", "drug_id": "z", "drug_name": "package alone", "is_brand": "Y"},
    ]
    drugs = [
        {"drug_id": "x", "drug_name": "normal brand", "is_brand": "TRUE"},
        {"drug_id": "y", "drug_name": None, "is_brand": "No"},
    ]
    classes = [{"drug_id": "x", "atc_1_name": "one", "atc_4_name": "four"}]
    practitioners = [
        {"practitioner_id": "d", "data_source": "a", "specialty": "doctor a"},
        {"practitioner_id": "d", "data_source": "b", "specialty": "doctor b"},
    ]
    frame = pharmacy(given, claims, packages, drugs, classes, practitioners)
    columns = (
        "pharmacy_claim_id",
        "ndc_description",
        "rxnorm_description",
        "brand_name",
        "brand_vs_generic",
        "ingredient_name",
        "atc_4_name",
        "prescribing_specialty",
    )
    assert rows(frame, *columns) == [
        ("brand", "package brand", "normal brand", "normal brand", "brand")
        + (None, "four", "doctor a"),
        ("generic", "package generic", "package generic", None, "generic", None, None, "doctor b"),
        ("package only", "package alone", "package alone", "package alone", "brand")
        + (None, None, None),
        ("unmatched", None, None, None, None, None, None, None),
    ]


@pytest.mark.parametrize(
    ("text", "kind"),
    [("t", "brand"), ("Yes", "brand"), ("0", "generic"), ("F", "generic"), ("maybe", None)],
)
def test_brand_flag_texts(given, text, kind):
    frame = pharmacy(
        given,
        [{"pharmacy_claim_id": "c", "data_source": "a", "ndc_code": "1"}],
        [{"ndc11": "1", "drug_id": "x", "drug_name": "n", "is_brand": text}],
    )
    assert rows(frame, "brand_vs_generic") == [(kind,)]


def test_brand_flags_of_different_types(given, spark):
    """A boolean or a number in one table and text in the other."""
    claims = [{"pharmacy_claim_id": i, "data_source": "a", "ndc_code": i} for i in "123"]
    packages = given(
        "drug_packages",
        *[{"ndc11": i, "drug_id": i, "drug_name": "n", "is_brand": "no"} for i in "123"],
    )
    flagged = spark.createDataFrame(
        [("1", "a", True), ("2", "b", False)], "drug_id string, drug_name string, is_brand boolean"
    )
    for drugs in (flagged, flagged.withColumn("is_brand", F.col("is_brand").cast("int"))):
        frame = facts.pharmacy_claims(
            given("pharmacy_claim", *claims),
            packages,
            stage("drugs", drugs, RUN_TS),
            given("drug_classes"),
            given("practitioner"),
        )
        assert rows(frame, "pharmacy_claim_id", "brand_name", "brand_vs_generic") == [
            ("1", "a", "brand"),
            ("2", None, "generic"),
            ("3", None, "generic"),
        ]


def test_pharmacy_cost_edges_and_threshold(given):
    supplies = {
        "zero days": (100, 0),
        "unknown days": (100, None),
        "unknown paid": (None, 30),
        "at threshold": (950, 30),
        "below": (949, 30),
        "short": (100, 3),
    }
    claims = [
        {"pharmacy_claim_id": i, "data_source": "a", "paid_amount": p, "days_supply": d}
        for i, (p, d) in supplies.items()
    ]
    frame = pharmacy(given, claims)
    columns = ("pharmacy_claim_id", "thirty_day_equivalent_cost", "specialty_tier")
    assert [(i, c if c is None else round(c, 6), t) for i, c, t in rows(frame, *columns)] == [
        ("at threshold", 950.0, 1),
        ("below", 949.0, 0),
        ("short", 1000.0, 1),
        ("unknown days", None, 0),
        ("unknown paid", None, 0),
        ("zero days", None, 0),
    ]
    cheaper = pharmacy(given, claims, specialty_threshold=940)
    assert ("below", 1) in rows(cheaper, "pharmacy_claim_id", "specialty_tier")


def test_quality_and_risk_facts_keep_the_source_grain(given):
    measures = facts.quality_measures(
        given(
            "quality_measures",
            {"person_id": "p", "data_source": "a", "measure_id": "m", "performance_flag": 1},
            {"person_id": "p", "data_source": "b", "measure_id": "m", "performance_flag": 0},
        )
    )
    assert rows(measures, "data_source", "performance_flag") == [("a", 1), ("b", 0)]
    scores = facts.risk_scores(
        given(
            "risk_scores",
            {"person_id": "p", "data_source": "a", "normalized_risk_score": 1.4},
            {"person_id": "p", "data_source": "b", "normalized_risk_score": 3.4},
        )
    )
    values = [float(v) for _, v in rows(scores, "data_source", "normalized_risk_score")]
    assert values == [1.4, 3.4]
