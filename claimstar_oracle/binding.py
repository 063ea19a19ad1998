"""Derive the input relations from the driver's TPC-H-like tables.

Each relation is a row source (a join of driver tables) plus one portable SQL expression per
column, valid in Spark and in other engines, so a check can bind the same inputs elsewhere.
Columns of a contract without an expression of their own get a filler that varies with a key of
the row, which makes swapped or lost columns visible in results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.sources.contracts import CONTRACTS, COST_MEASURES
from claimstar.sources.mapping import raw_columns

Read = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Rows:
    """A row source: how Spark composes it, and the same as the text of a FROM clause.

    ``reduced`` marks a source whose Spark side already has one row per row of a distinct or
    aggregated relation bound to it, the sum of the latter under the name ``paid``.
    """

    spark: Callable[[Read], DataFrame]
    sql: str
    reduced: bool = False


@dataclass(frozen=True)
class Binding:
    rows: Rows
    key: str
    day: str
    columns: Mapping[str, str] = field(default_factory=dict)
    where: str | None = None
    distinct: bool = False
    aggregates: Mapping[str, str] = field(default_factory=dict)

    @property
    def expressions(self) -> dict[str, str]:
        return {**self.columns, **self.aggregates}


def _each(column: str, *values) -> Callable[[DataFrame], DataFrame]:
    """Repeat every row once per value."""
    return lambda frame: frame.withColumn(
        column, F.explode(F.array(*[F.lit(v) for v in values]))
    )


_each_source = _each("source_name", "src_a", "src_b")
_SQL_SOURCES = "cross join (select 'src_a' as source_name union all select 'src_b') s"


def _orders(read: Read) -> DataFrame:
    """Orders with their customers; of an order's date the day is used, which is less to move than a time."""
    orders = read("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return orders.join(read("customer"), F.expr("o_custkey = c_custkey"))


def _monthly_orders(read: Read, source: str, *others: str) -> DataFrame:
    """Orders with their customers, cut to what a month shows of them before they move."""
    orders = read("orders").selectExpr(
        "o_custkey",
        "last_day(cast(o_orderdate as date)) as o_orderdate",
        f"{source} as o_orderkey",
        *others,
    )
    return orders.join(read("customer"), F.expr("o_custkey = c_custkey"))


def _order_cells(read: Read) -> DataFrame:
    """Orders summed up (``paid``) by what the texts of a customer's month are made of, before they are."""
    source = "case when o_orderkey % 2 = 0 then 0 else 1 end"
    return (
        _monthly_orders(read, source, "o_totalprice")
        .groupBy(
            "o_custkey",
            "c_custkey",
            F.expr(_PAYER).alias("c_mktsegment"),
            F.expr("case when c_mktsegment = 'HOUSEHOLD' then null else c_nationkey % 4 end").alias("c_nationkey"),
            "o_orderdate",
            "o_orderkey",
        )
        .agg(F.expr(_PAID).alias("paid"))
    )


def _order_months(read: Read) -> DataFrame:
    """Orders reduced to customer, month and source, before any text is made of them."""
    months = _monthly_orders(read, "o_orderkey % 2")
    return months.select("o_custkey", "c_custkey", "c_mktsegment", "c_nationkey", "o_orderdate", "o_orderkey").distinct()


def _lines(read: Read) -> DataFrame:
    """Lines with part and order, whose lines are neighbours where they meet it by a shuffle.

    What is made of them then moves next to what is like it, and so in fewer bytes.
    """
    return (
        read("lineitem")
        .join(read("part"), F.expr("l_partkey = p_partkey"))
        .join(_orders(read), F.expr("l_orderkey = o_orderkey"))
    )


def _spread_lines(read: Read) -> DataFrame:
    """Lines that many texts are made of, spread over as many tasks as Spark shuffles to.

    By their own few bytes the lines would lie in about a task a core, the last of which runs alone.
    """
    lines = _lines(read)
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(tasks, "l_orderkey", "l_linenumber")


def _shuffled_lines(read: Read) -> DataFrame:
    """Lines of a table that shuffles none of its own: a broadcast leaves them to the tasks of orders.

    Lines of a part are neighbours, as they are wanted by its code; of their ship date the day is used.
    """
    lines = read("lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    orders = _orders(read)
    key = F.col("l_orderkey").cast(orders.schema["o_orderkey"].dataType)  # moves once, not under both names
    lines = lines.join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey")).drop("o_orderkey")
    return lines.join(read("part"), F.expr("l_partkey = p_partkey")).withColumn("o_orderkey", key)


def _days(read: Read) -> DataFrame:
    ordered = read("orders").select(F.col("o_orderdate").cast("date").alias("d"))
    shipped = read("lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    return ordered.unionAll(shipped).distinct()


ORDERS = Rows(_orders, "orders join customer on o_custkey = c_custkey")
ORDER_MONTHS = Rows(_order_months, ORDERS.sql, reduced=True)
ORDER_CELLS = Rows(_order_cells, ORDERS.sql, reduced=True)
LINES = Rows(
    _lines,
    "lineitem join orders on l_orderkey = o_orderkey"
    " join customer on o_custkey = c_custkey join part on l_partkey = p_partkey",
)
RAW_LINES = Rows(_spread_lines, LINES.sql)
PHARMACY_LINES = Rows(_shuffled_lines, LINES.sql)
CUSTOMERS = Rows(lambda read: _each_source(read("customer")), f"customer {_SQL_SOURCES}")
GAPS = Rows(
    lambda read: _each_source(
        read("customer").join(read("nation"), F.expr("c_nationkey = n_nationkey"))
    ),
    f"customer join nation on c_nationkey = n_nationkey {_SQL_SOURCES}",
)
SUPPLIERS = Rows(lambda read: _each_source(read("supplier")), f"supplier {_SQL_SOURCES}")
EVENTS = Rows(lambda read: _each_source(read("events")), f"events {_SQL_SOURCES}")
PARTS = Rows(lambda read: read("part"), "part")
FLAGGED_PARTS = Rows(
    lambda read: _each("l_returnflag", "A", "N", "R")(read("part")),
    "part cross join (select distinct l_returnflag from lineitem) f",
)
DAYS = Rows(
    _days,
    "(select cast(o_orderdate as date) as d from orders"
    " union select cast(l_shipdate as date) from lineitem) t",
)
ORDER_PQIS = Rows(
    lambda read: _each("pqi", "05", "08")(_orders(read)),
    f"{ORDERS.sql} cross join (select '05' as pqi union all select '08') q",
)
DIAGNOSES = Rows(
    lambda read: _each("r", 1, 2)(read("customer").selectExpr("c_custkey % 50 as k").distinct()),
    "(select distinct c_custkey % 50 as k from customer) t"
    " cross join (select 1 as r union all select 2) r",
)

_ORDER_SOURCE = "case when o_orderkey % 2 = 0 then 'src_a' else 'src_b' end"
_ENCOUNTER = "'E' || cast(cast(floor(o_orderkey / 2) as bigint) as string)"
_PERSON = "'P' || cast(o_custkey as string)"
_CUSTOMER = "'P' || cast(c_custkey as string)"
_MEMBER = "case when c_custkey % 41 = 0 then null else 'M' || cast(c_custkey as string) end"
_PAYER = "case when c_mktsegment = 'MACHINERY' then null else c_mktsegment end"
_PLAN = (
    "case when c_mktsegment = 'HOUSEHOLD' then null"
    " else 'plan_' || cast(c_nationkey % 4 as string) end"
)
_MONTH = "cast(year(o_orderdate) * 100 + month(o_orderdate) as string)"
_MEMBER_MONTH = f"{_PERSON} || '|' || {_MONTH} || '|' || {_ORDER_SOURCE}"
_LINE = (
    "cast(l_orderkey as string) || '|' || cast(l_linenumber as string) || '|' ||"
    " cast(l_partkey as string) || '|' || cast(l_suppkey as string) || '|' ||"
    " cast(cast(l_shipdate as date) as string)"
)
_CATEGORY_1 = (
    "case when l_returnflag = 'A' then 'inpatient'"
    " when l_returnflag = 'N' then 'outpatient' else 'office-based' end"
)
_CATEGORY_3 = "case when p_size % 10 = 0 then null else p_brand end"
_GROUP = (
    "case o_orderpriority when '1-URGENT' then 'outpatient'"
    " when '2-HIGH' then 'inpatient' when '3-MEDIUM' then 'office based'"
    " when '4-NOT SPECIFIED' then 'inpatient' else 'outpatient' end"
)
_TYPE = (
    "case o_orderpriority when '1-URGENT' then 'emergency department'"
    " when '2-HIGH' then 'acute inpatient' when '3-MEDIUM' then 'office visit'"
    " when '4-NOT SPECIFIED' then 'inpatient long term acute care'"
)
_ADMITTED = "o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED')"
_NDC = "lpad(cast({} as string), 11, '0')"
_DRUG = "'RX' || cast(p_partkey % 500 as string)"
_ORDER_DAY = "cast(o_orderdate as date)"
_FIXED_DAY = "date '2024-01-01'"
_PAID = "sum(cast(o_totalprice as decimal(18,2)))"
_COVERAGE = {
    "person_id": _PERSON,
    "member_id": _MEMBER,
    "year_month": _MONTH,
    "payer": _PAYER,
    "plan": _PLAN,
    "data_source": _ORDER_SOURCE,
}


def _multiple(measure: str) -> str:
    """total_paid itself, and a fixed multiple of it for every other cost measure."""
    others = [m for m in COST_MEASURES if m != "total_paid"]
    factor = 1 if measure == "total_paid" else 2 + others.index(measure)
    return f"cast({_PAID} * {factor} as decimal(18,2))"


def _unless(matches: str, key: str) -> str:
    """The key where it shall match, and one that matches nothing elsewhere: no row is left out."""
    return f"case when {matches} then {key} else 'X' || {key} end"


_BOUND: dict[str, Binding] = {
    "patient": Binding(
        CUSTOMERS,
        "c_custkey",
        _FIXED_DAY,
        {
            "person_id": _unless("c_custkey % 3 = 0 or source_name = 'src_a'", _CUSTOMER),
            "data_source": "source_name",
            "last_name": "c_name",
            "sex": "case when c_custkey % 2 = 0 then 'female' else 'male' end",
            "birth_date": (
                "make_date(cast(1930 + c_custkey % 80 as int),"
                " cast(1 + c_custkey % 12 as int), cast(1 + c_custkey % 28 as int))"
            ),
            "age_group": "case when c_custkey % 80 < 20 then '65+' else '0-64' end",
        },
    ),
    "eligibility": Binding(
        ORDERS,
        "c_custkey",
        _ORDER_DAY,
        {"person_id": _PERSON, "payer": _PAYER, "data_source": _ORDER_SOURCE},
        distinct=True,
    ),
    "encounter": Binding(
        ORDERS,
        "o_orderkey",
        _ORDER_DAY,
        {
            "encounter_id": _ENCOUNTER,
            "data_source": _ORDER_SOURCE,
            "person_id": _PERSON,
            "encounter_type": (
                f"{_TYPE} else case when o_orderkey % 7 = 0 then 'unmapped type'"
                " when o_orderkey % 11 = 0 then null else 'urgent care' end end"
            ),
            "encounter_group": _GROUP,
            "encounter_source_type": (
                "case when o_orderstatus = 'P' and o_custkey % 2 = 0"
                " then 'clinical' else 'claim' end"
            ),
            "encounter_start_date": _ORDER_DAY,
            "encounter_end_date": f"{_ORDER_DAY} + cast(o_orderkey % 9 as int)",
            "length_of_stay": "cast(o_orderkey % 9 as int)",
            "primary_diagnosis_code_type": (
                "case when o_orderkey % 5 = 0 then 'icd-9-cm'"
                " when o_orderkey % 3 = 0 then 'ICD-10-CM' else 'icd-10-cm' end"
            ),
            "primary_diagnosis_code": "'D' || cast(o_custkey % 50 as string)",
            "paid_amount": "cast(o_totalprice as decimal(18,2))",
            "allowed_amount": (
                "cast(cast(o_totalprice as decimal(18,2)) + 100 as decimal(18,2))"
            ),
        },
    ),
    "medical_claim": Binding(
        LINES,
        "l_partkey",
        _ORDER_DAY,
        {
            "medical_claim_id": _LINE,
            "encounter_id": f"case when l_suppkey % 37 = 0 then null else {_ENCOUNTER} end",
            "data_source": _ORDER_SOURCE,
            "person_id": _PERSON,
            "member_id": _MEMBER,
            "payer": _PAYER,
            "plan": _PLAN,
            "member_month_id": _MEMBER_MONTH,
            "claim_id": "'C' || cast(l_orderkey as string)",
            "claim_line_number": "l_linenumber",
            "claim_type": (
                "case when l_linestatus = 'F' then 'institutional' else 'professional' end"
            ),
            "claim_start_date": _ORDER_DAY,
            "claim_end_date": "cast(l_shipdate as date)",
            "service_category_1": _CATEGORY_1,
            "service_category_2": "p_type",
            "service_category_3": _CATEGORY_3,
            "rendering_npi": (
                "case when l_suppkey % 29 = 0 then null"
                " else 'N' || cast(cast(floor(l_suppkey / 2) as bigint) as string) end"
            ),
            "paid_amount": (
                "case when l_linenumber = 7 then null"
                " else cast(l_extendedprice as decimal(18,2)) end"
            ),
            "allowed_amount": (
                "cast(cast(l_extendedprice as decimal(18,2)) + 100 as decimal(18,2))"
            ),
            "enrollment_flag": "case when l_linenumber = 5 then 0 else 1 end",
            "last_run_ts": "cast(l_shipdate as timestamp)",
        },
    ),
    "pharmacy_claim": Binding(
        PHARMACY_LINES,
        "l_suppkey",
        "cast(l_shipdate as date)",
        {
            "pharmacy_claim_id": _LINE,
            "data_source": f"case when l_linenumber = 1 then 'src_c' else {_ORDER_SOURCE} end",
            "claim_id": "'RX' || cast(l_orderkey as string)",
            "claim_line_number": "l_linenumber",
            "person_id": _PERSON,
            "member_id": _MEMBER,
            "payer": _PAYER,
            "plan": _PLAN,
            "member_month_id": _MEMBER_MONTH,
            "ndc_code": _NDC.format("l_partkey"),
            "paid_amount": "cast(floor(l_extendedprice / 100) as decimal(18,2))",
            "days_supply": (
                "case when l_linenumber = 6 then null else cast(l_quantity as int) % 26 end"
            ),
            "prescribing_provider_id": "'PR' || cast(l_suppkey as string)",
            "dispensing_date": "cast(l_shipdate as date)",
        },
    ),
    "practitioner": Binding(
        SUPPLIERS,
        "s_suppkey",
        _FIXED_DAY,
        {
            "practitioner_id": "'PR' || cast(s_suppkey as string)",
            "npi": "'N' || cast(cast(floor(s_suppkey / 2) as bigint) as string)",
            "data_source": "source_name",
            "specialty": (
                "case when s_suppkey % 9 = 0 then null else 'SPEC' || cast((s_nationkey +"
                " case when source_name = 'src_a' then 0 else 3 end) % 6 as string) end"
            ),
        },
    ),
    "service_categories": Binding(
        FLAGGED_PARTS,
        "p_partkey",
        _FIXED_DAY,
        {
            "service_category_1": _CATEGORY_1,
            "service_category_2": _unless(
                "not (p_type = 'PROMO' and p_brand = 'Brand#13')", "p_type"
            ),
            "service_category_3": _CATEGORY_3,
        },
        distinct=True,
    ),
    "calendar": Binding(
        DAYS,
        "day(d)",
        "d",
        {
            "full_date": "d",
            "year": "cast(year(d) as int)",
            "month": "cast(month(d) as int)",
            "day": "cast(day(d) as int)",
            "year_month": "cast(year(d) * 100 + month(d) as string)",
            "year_month_int": "cast(year(d) * 100 + month(d) as int)",
            "first_day_of_month": "d - cast(day(d) - 1 as int)",
            "last_day_of_month": "last_day(d)",
        },
    ),
    "member_month": Binding(
        ORDER_MONTHS,
        "c_custkey",
        "last_day(cast(o_orderdate as date))",
        {"member_month_id": _MEMBER_MONTH, **_COVERAGE},
        distinct=True,
    ),
    "cost": Binding(
        ORDER_CELLS,
        "c_custkey",
        "last_day(cast(o_orderdate as date))",
        {**_COVERAGE, "person_id": _unless("c_custkey % 6 <> 0", _PERSON)},
        aggregates={m: _multiple(m) for m in COST_MEASURES},
    ),
    "risk_scores_monthly": Binding(
        ORDER_MONTHS,
        "c_custkey",
        "last_day(cast(o_orderdate as date))",
        {
            "person_id": _unless("c_custkey % 4 <> 0", _PERSON),
            "payer": _PAYER,
            "data_source": _ORDER_SOURCE,
            "risk_model_code": (
                "case when c_custkey % 5 = 0 then 'institutional' else 'community' end"
            ),
            "collection_end_date": "last_day(cast(o_orderdate as date))",
            "normalized_risk_score": (
                "cast(case when year(o_orderdate) = 1995 and month(o_orderdate) = 1 then 0"
                " else (50 + c_custkey % 30) / 100.0 end as decimal(18,6))"
            ),
        },
        distinct=True,
    ),
    "risk_scores": Binding(
        CUSTOMERS,
        "c_custkey",
        _FIXED_DAY,
        {
            "person_id": _CUSTOMER,
            "payer": _PAYER,
            "data_source": "source_name",
            "payment_year": "cast(2018 as int)",
            "v24_risk_score": "cast((c_custkey % 30) / 10.0 as decimal(18,6))",
            "v28_risk_score": "cast((c_custkey % 40) / 10.0 as decimal(18,6))",
            "member_months": "cast(1 + c_custkey % 12 as int)",
        },
    ),
    "risk_factors": Binding(
        CUSTOMERS,
        "c_custkey",
        _FIXED_DAY,
        {
            "person_id": _CUSTOMER,
            "payer": _PAYER,
            "data_source": "source_name",
            "factor_type": "case when c_custkey % 4 = 0 then 'demographic' else 'disease' end",
            "risk_factor_description": "'factor ' || cast(c_nationkey as string)",
            "coefficient": "cast(c_nationkey / 100.0 as decimal(18,6))",
            "model_version": "'v28'",
            "payment_year": "cast(2018 as int)",
        },
    ),
    "hcc_suspects": Binding(
        GAPS,
        "c_custkey",
        _FIXED_DAY,
        {
            "person_id": _CUSTOMER,
            "payer": _PAYER,
            "data_source": "source_name",
            "model_version": "'v28'",
            "hcc_code": "cast(n_nationkey as string)",
            "hcc_description": "n_name",
        },
    ),
    "quality_measures": Binding(
        EVENTS,
        "user_id",
        _FIXED_DAY,
        {
            "person_id": "'P' || cast(user_id as string)",
            "data_source": "source_name",
            "measure_id": "event_type",
            "measure_version": "'2025'",
            "performance_period_begin": "date '2024-01-01'",
            "performance_period_end": "date '2024-12-31'",
            "denominator_flag": "cast(1 as int)",
        },
        aggregates={
            "numerator_flag": "cast(max(case when value > 20 then 1 else 0 end) as int)"
        },
    ),
    "augmented_admissions": Binding(
        ORDERS,
        "o_orderkey",
        _ORDER_DAY,
        {"encounter_id": _ENCOUNTER, "data_source": _ORDER_SOURCE},
        where=_ADMITTED,
    ),
    "readmissions": Binding(
        ORDERS,
        "o_orderkey",
        _ORDER_DAY,
        {
            "encounter_id": _unless("o_orderkey % 3 <> 0", _ENCOUNTER),
            "data_source": _ORDER_SOURCE,
            "index_admission_flag": "cast(1 as int)",
            "readmit_30_flag": "cast(case when o_orderkey % 4 = 0 then 1 else 0 end as int)",
            "days_to_readmit": (
                "cast(case when o_orderkey % 4 = 0 then o_orderkey % 30 end as int)"
            ),
        },
        where=_ADMITTED,
    ),
    "pqi_summary": Binding(
        ORDER_PQIS,
        "o_orderkey",
        _ORDER_DAY,
        {
            "encounter_id": _unless(
                "o_orderkey % 5 = 0 and (pqi = '05' or o_orderkey % 2 = 0)", _ENCOUNTER
            ),
            "data_source": _ORDER_SOURCE,
            "pqi_number": "pqi",
            "pqi_name": "'PQI ' || pqi",
        },
        where=_ADMITTED,
    ),
    "ed_classification": Binding(
        ORDERS,
        "o_orderkey",
        _ORDER_DAY,
        {
            "encounter_id": _unless("o_orderkey % 6 <> 5", _ENCOUNTER),
            "person_id": _PERSON,
            "data_source": _ORDER_SOURCE,
            "ed_classification_order": (
                "case when o_orderkey % 6 = 4 then 'n/a'"
                " else cast(1 + o_orderkey % 6 as string) end"
            ),
            "ed_classification_description": (
                "'class ' || cast(1 + o_orderkey % 6 as string)"
            ),
        },
        where="o_orderpriority = '1-URGENT'",
    ),
    "diagnosis_categories": Binding(
        DIAGNOSES,
        "k",
        _FIXED_DAY,
        {
            "code": _unless("k % 4 <> 0", "'D' || cast(k as string)"),
            "ccsr_parent_category": "'BODY' || cast(k % 7 as string)",
            "ccsr_category": "'CAT' || cast(k * 10 + r as string)",
            "ccsr_category_description": "'category ' || cast(k * 10 + r as string)",
            "ccsr_category_rank": "r",
        },
    ),
    "encounter_group_keys": Binding(
        ORDERS,
        "o_orderkey",
        _ORDER_DAY,
        {
            "encounter_group": _GROUP,
            "encounter_group_sk": (
                "case when o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED') then '1'"
                " when o_orderpriority = '3-MEDIUM' then '3' else '2' end"
            ),
        },
        distinct=True,
    ),
    "encounter_type_keys": Binding(
        ORDERS,
        "o_orderkey",
        _ORDER_DAY,
        {
            "encounter_type": f"{_TYPE} else 'urgent care' end",
            "encounter_type_sk": (
                "case o_orderpriority when '1-URGENT' then '2' when '2-HIGH' then '1'"
                " when '3-MEDIUM' then '3' when '4-NOT SPECIFIED' then '32' else '4' end"
            ),
            "encounter_group_sk": (
                "case when o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED') then '1'"
                " when o_orderpriority = '3-MEDIUM' then '3' else '2' end"
            ),
        },
        distinct=True,
    ),
    "drug_packages": Binding(
        PARTS,
        "p_partkey",
        _FIXED_DAY,
        {
            "ndc11": _unless("p_partkey % 10 <> 9", _NDC.format("p_partkey")),
            "drug_id": _DRUG,
            "drug_name": "p_name",
            "is_brand": (
                "case p_partkey % 6 when 0 then 'TRUE' when 1 then '1' when 2 then 'no'"
                " when 3 then 'F' when 4 then 'maybe' else null end"
            ),
        },
    ),
    "drugs": Binding(
        PARTS,
        "p_partkey % 500",
        _FIXED_DAY,
        {
            "drug_id": _unless("p_partkey % 500 % 7 <> 0", _DRUG),
            "drug_name": "'drug ' || cast(p_partkey % 500 as string)",
            "is_brand": (
                "case p_partkey % 500 % 4 when 0 then 'y' when 1 then 'false' else null end"
            ),
        },
        distinct=True,
    ),
    "drug_classes": Binding(
        PARTS,
        "p_partkey % 500",
        _FIXED_DAY,
        {
            "drug_id": _unless("p_partkey % 500 % 5 <> 0", _DRUG),
            **{
                f"atc_{level}_name": (
                    f"'ATC{level}-' || cast(p_partkey % 500 % {modulus} as string)"
                )
                for level, modulus in ((1, 14), (2, 20), (3, 30), (4, 45))
            },
        },
        distinct=True,
    ),
}

# Raw extracts for the mapping operators: fillers over a row source, with some codes and
# descriptions missing so that the first-of-two rules have both cases to decide.
_RAW_ROWS = {
    "appointment": (ORDERS, "o_orderkey"),
    "condition": (ORDERS, "o_orderkey"),
    "eligibility": (CUSTOMERS, "c_custkey"),
    "encounter": (ORDERS, "o_orderkey"),
    "immunization": (ORDERS, "o_orderkey"),
    "lab_result": (ORDERS, "o_orderkey"),
    "location": (SUPPLIERS, "s_suppkey"),
    "medical_claim": (RAW_LINES, "l_partkey"),
    "medication": (ORDERS, "o_orderkey"),
    "observation": (ORDERS, "o_orderkey"),
    "patient": (CUSTOMERS, "c_custkey"),
    "pharmacy_claim": (RAW_LINES, "l_suppkey"),
    "practitioner": (SUPPLIERS, "s_suppkey"),
    "procedure": (ORDERS, "o_orderkey"),
    "provider_attribution": (CUSTOMERS, "c_custkey"),
}
_RAW_SPECIAL = {
    "type_description": "case when o_orderkey % 3 = 0 then null else 'visit' end",
    "status_description": "case when o_orderkey % 2 = 0 then null else o_orderstatus end",
    "person_id": "'P' || cast({key} as string)",
    "claim_line_number": "l_linenumber",
}


def filler(column: str, kind: str, rows: Rows, key: str, day: str) -> str:
    """A value that depends on the column and, texts of claim lines apart, on a key of the row."""
    if kind == "text" and rows.sql == LINES.sql:
        return f"'{column}'"
    spread = 5 + len(column) % 9
    if kind == "int":
        return f"cast({key} % {spread} as int)"
    if kind == "number":
        return f"cast({key} % {spread * 100} as decimal(18,2))"
    if kind == "date":
        return f"{day} + cast({key} % {spread} as int)"
    if kind == "time":
        return f"cast({day} as timestamp)"
    return (
        f"case {key} % {spread} when 0 then null when 1 then '{column} one'"
        f" when 2 then '{column} two' else '{column}' end"
    )


def _raw_kind(column: str) -> str:
    if column.endswith(("_date",)) or "procedure_date" in column:
        return "date"
    if column.endswith("_datetime"):
        return "time"
    if column.endswith(("_amount", "quantity")):
        return "number"
    return "int" if column in ("days_supply", "refills", "condition_rank") else "text"


def _with_fillers(name: str, binding: Binding) -> Binding:
    columns = dict(binding.columns)
    for column, kind in CONTRACTS[name].items():
        if column not in binding.expressions:
            columns[column] = filler(column, kind, binding.rows, binding.key, binding.day)
    return Binding(
        binding.rows,
        binding.key,
        binding.day,
        columns,
        binding.where,
        binding.distinct,
        binding.aggregates,
    )


def _raw_binding(name: str) -> Binding:
    rows, key = _RAW_ROWS[name]
    day = _ORDER_DAY if rows in (ORDERS, RAW_LINES) else _FIXED_DAY
    columns = {}
    for column in raw_columns(name):
        special = _RAW_SPECIAL.get(column)
        columns[column] = (
            special.format(key=key)
            if special
            else filler(column, _raw_kind(column), rows, key, day)
        )
    return Binding(rows, key, day, columns)


BINDINGS: dict[str, Binding] = {n: _with_fillers(n, b) for n, b in _BOUND.items()}
RAW_BINDINGS: dict[str, Binding] = {n: _raw_binding(n) for n in _RAW_ROWS}


def _bind(binding: Binding, read: Read) -> DataFrame:
    frame = binding.rows.spark(read)
    if binding.where:
        frame = frame.filter(binding.where)
    if binding.aggregates and binding.rows.reduced:
        totals = {name: text.replace(_PAID, "paid") for name, text in binding.aggregates.items()}
        texts = {**binding.columns, **totals}
        return frame.selectExpr(*[f"{text} as `{name}`" for name, text in texts.items()])
    if binding.aggregates:
        keys = [F.expr(text).alias(name) for name, text in binding.columns.items()]
        totals = [F.expr(text).alias(name) for name, text in binding.aggregates.items()]
        return frame.groupBy(*keys).agg(*totals)
    frame = frame.selectExpr(*[f"{text} as `{name}`" for name, text in binding.columns.items()])
    return frame.distinct() if binding.distinct and not binding.rows.reduced else frame


@cache
def reader(spark: SparkSession, sf_dir: str) -> Read:
    """Read driver tables, each file listing and footer once per session."""
    return cache(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))


class BoundInputs(Mapping):
    """All input relations over the driver tables of ``sf_dir``, each composed when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._read = reader(spark, sf_dir)
        self._bound: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._bound:
            self._bound[name] = _bind(BINDINGS[name], self._read)
        return self._bound[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BINDINGS)

    def __len__(self) -> int:
        return len(BINDINGS)


def bind_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw extract over the driver tables of ``sf_dir``."""
    return _bind(RAW_BINDINGS[name], reader(spark, sf_dir))


def bind_sql(binding: Binding) -> str:
    """The bound relation as a portable query."""
    columns = ", ".join(f'{text} as "{name}"' for name, text in binding.expressions.items())
    distinct = "distinct " if binding.distinct else ""
    where = f" where {binding.where}" if binding.where else ""
    group = ""
    if binding.aggregates:
        group = " group by " + ", ".join(str(i + 1) for i in range(len(binding.columns)))
    return f"select {distinct}{columns} from {binding.rows.sql}{where}{group}"
