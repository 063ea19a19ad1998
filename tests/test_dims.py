"""Dimensions: keys, ties, ranges and empty inputs."""

import hashlib
import random
from decimal import Decimal

from conftest import RUN_TS, rows

from claimstar.operators import dims


def claim(encounter, npi, paid, source="a", stamp="2024-01-01 00:00:00", **more):
    return {
        "encounter_id": encounter,
        "rendering_npi": npi,
        "paid_amount": paid,
        "data_source": source,
        "last_run_ts": stamp,
        **more,
    }


def practitioner(npi, specialty, ident, source="a"):
    return {"npi": npi, "specialty": specialty, "practitioner_id": ident, "data_source": source}


def top(given, claims, practitioners=()):
    return dims.encounter_provider(
        given("medical_claim", *claims), given("practitioner", *practitioners)
    )


def test_data_source_is_the_union_with_hashed_key(given):
    frame = dims.data_source(
        given("eligibility", {"data_source": "a"}, {"data_source": "a"}),
        given("medical_claim", claim("e", "n", 1, "b")),
        given("pharmacy_claim", {"data_source": "c"}, {"data_source": None}),
        RUN_TS,
    )
    null_key = hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()
    expected = [(hashlib.md5(s.encode()).hexdigest(), s) for s in "abc"] + [(null_key, None)]
    assert sorted(rows(frame, "data_source_sk", "data_source"), key=str) == sorted(
        expected, key=str
    )


def test_date_keeps_both_bounds(given):
    days = [{"full_date": f"2024-01-0{i}"} for i in range(1, 8)]
    claims = given(
        "medical_claim",
        claim("e", "n", 1, claim_start_date="2024-01-02"),
        claim("e", "n", 1, claim_start_date="2024-01-05"),
    )
    frame = dims.date(given("calendar", *days, *days), claims)
    assert [r[0].day for r in rows(frame, "full_date")] == [2, 3, 4, 5]


def test_date_is_empty_without_claims(given):
    frame = dims.date(given("calendar", {"full_date": "2024-01-01"}), given("medical_claim"))
    assert frame.count() == 0


def test_highest_paid_provider_wins_after_summing(given):
    claims = [claim("e", "n1", 60), claim("e", "n2", 50), claim("e", "n2", 50)]
    assert rows(top(given, claims), "encounter_id", "primary_provider_id") == [("e", "n2")]


def test_provider_ties_go_to_lowest_npi_and_missing_npi_last(given):
    claims = [claim("tie", "n2", 5), claim("tie", "n1", 5), claim("tie", None, 5)]
    claims += [claim("none paid", "n9", None), claim("none paid", None, None)]
    claims += [claim("null best", None, 9), claim("null best", "n1", 8)]
    assert rows(top(given, claims), "encounter_id", "primary_provider_id") == [
        ("none paid", "n9"),
        ("null best", None),
        ("tie", "n1"),
    ]


def test_unpaid_counts_as_zero_against_negative(given):
    claims = [claim("e", "n1", -5), claim("e", "n2", None)]
    assert rows(top(given, claims), "primary_provider_id") == [("n2",)]


def test_provider_is_scoped_by_source_and_stamp_is_the_latest(given):
    claims = [
        claim("e", "n1", 5, "a", "2024-01-01 00:00:00"),
        claim("e", "n1", 5, "a", "2024-03-01 00:00:00"),
        claim("e", "n2", 5, "b"),
        claim("e", "n3", 500, None),
    ]
    practitioners = [practitioner("n1", "s-a", "1", "a"), practitioner("n1", "s-b", "1", "b")]
    frame = top(given, claims, practitioners)
    assert rows(frame, "data_source", "primary_provider_id", "specialty") == [
        ("a", "n1", "s-a"),
        ("b", "n2", None),
    ]
    assert frame.filter("data_source = 'a'").first()["last_run_ts"].month == 3


def test_claims_without_encounter_give_one_row_per_source(given):
    claims = [claim(None, f"n{i}", i) for i in range(20)] + [claim(None, "n1", 1, "b")]
    assert rows(top(given, claims), "encounter_id", "data_source", "primary_provider_id") == [
        (None, "a", "n19"),
        (None, "b", "n1"),
    ]


def test_practitioner_dedup_takes_lowest_id_then_specialty_nulls_last(given):
    frame = dims.practitioner_by_npi(
        given(
            "practitioner",
            practitioner("n1", "late", "2"),
            practitioner("n1", "zeta", "1"),
            practitioner("n1", "alpha", "1"),
            practitioner("n1", None, "1"),
            practitioner("n2", "only", None),
            practitioner("n3", "with id", "9"),
            practitioner("n3", "without id", None),
        )
    )
    assert rows(frame, "npi", "specialty") == [
        ("n1", "alpha"),
        ("n2", "only"),
        ("n3", "with id"),
    ]


def test_provider_against_brute_force(given):
    chance = random.Random(7)
    claims = [
        claim(
            chance.choice(["e1", "e2", "e3", None]),
            chance.choice(["n1", "n2", "n3", None]),
            chance.choice([None, -1, 0, 1, 2]),
            chance.choice(["a", "b"]),
        )
        for _ in range(300)
    ]
    practitioners = [
        practitioner(n, chance.choice(["s1", "s2", None]), chance.choice(["1", "2", None]), s)
        for n in ("n1", "n2")
        for s in "ab"
        for _ in range(3)
    ]
    specialty = {}
    for p in practitioners:
        order = tuple((p[c] is None, p[c] or "") for c in ("practitioner_id", "specialty"))
        key = p["npi"], p["data_source"]
        if key not in specialty or order < specialty[key][0]:
            specialty[key] = order, p["specialty"]
    paid = {}
    for c in claims:
        key = c["encounter_id"], c["data_source"], c["rendering_npi"]
        paid[key] = paid.get(key, 0) + (c["paid_amount"] or 0)
    best = {}
    for (encounter, source, npi), amount in paid.items():
        order = (-amount, npi is None, npi or "")
        if (encounter, source) not in best or order < best[encounter, source][0]:
            best[encounter, source] = order, npi
    expected = [
        (e, s, npi, specialty.get((npi, s), (None, None))[1]) for (e, s), (_, npi) in best.items()
    ]
    actual = rows(
        top(given, claims, practitioners),
        "encounter_id",
        "data_source",
        "primary_provider_id",
        "specialty",
    )
    assert actual == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_member_key_and_null_propagation(given):
    frame = dims.member(
        given(
            "patient",
            {"person_id": "p", "data_source": "a", "latitude": 1.5},
            {"person_id": "p", "data_source": None},
        )
    )
    assert rows(frame, "person_sk", "latitude") == [("p|a", Decimal("1.500000")), (None, None)]


def test_member_month_keys(given):
    frame = dims.member_months(
        given(
            "member_month",
            {"person_id": "p", "data_source": "a", "year_month": "202401", "member_month_id": "1"},
        )
    )
    columns = ("member_month_sk", "patient_source_key", "year_nbr")
    assert rows(frame, *columns) == [("p|202401", "p|a", "2024")]


def test_service_category_null_levels_get_distinct_keys(given):
    levels = ("service_category_1", "service_category_2", "service_category_3")
    frame = dims.service_category(
        given(
            "service_categories",
            dict(zip(levels, ("x", "y", None))),
            dict(zip(levels, ("x", None, "y"))),
            dict(zip(levels, ("x", "y", None))),
        ),
        RUN_TS,
    )
    expected = hashlib.md5(b"x-y-_dbt_utils_surrogate_key_null_").hexdigest()
    keys = rows(frame, "service_category_sk")
    assert len(set(keys)) == 2 and (expected,) in keys
