"""Plans: pushdown, pruning, no Python in the data path, checked broadcasts, split hot keys."""

import re
from dataclasses import replace

import pytest
from conftest import RUN_TS, SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as registry
from claimstar.functions.joins import bounded, left_join_null_safe, skew_splittable_join
from claimstar.operators import dims, enrich, facts
from claimstar.plans.star import INTERMEDIATES, TABLES, Star
from claimstar.sources.contracts import COST_MEASURES, schema
from claimstar_oracle.binding import BINDINGS, ORDERS, BoundInputs, _bind, bind_raw


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """settings(key=value) for the duration of a test; dots are written as double underscores."""
    changed = {}

    def change(values):
        for key, value in values.items():
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_bucketed_claims_are_ranked_without_moving(spark, stored_inputs):
    spark.sql("create database if not exists bucketed")
    (
        stored_inputs["medical_claim"]
        .write.mode("overwrite")
        .bucketBy(4, "encounter_id", "data_source")
        .saveAsTable("bucketed.medical_claim")
    )
    inputs = {**stored_inputs, "medical_claim": spark.table("bucketed.medical_claim")}
    bucketed = Star(inputs, RUN_TS).table("dim_encounter_provider")
    plain = Star(stored_inputs, RUN_TS).table("dim_encounter_provider")
    assert "hashpartitioning(encounter_id" in physical(plain)
    assert "hashpartitioning(encounter_id" not in physical(bucketed)
    assert sorted(bucketed.collect(), key=str) == sorted(plain.collect(), key=str)


@pytest.mark.parametrize("name", [*TABLES, *INTERMEDIATES])
def test_no_python_and_no_cross_product(spark, name):
    plan = physical(Star(BoundInputs(spark, SF_DIR), RUN_TS).table(name))
    for operator in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert operator not in plan


@pytest.fixture(scope="module")
def stored_inputs(spark, tmp_path_factory):
    """Inputs as Parquet files of their own, as a user would have them."""
    root = tmp_path_factory.mktemp("inputs")
    bound = BoundInputs(spark, SF_DIR)
    for name in ("encounter", "medical_claim", "calendar", "practitioner"):
        bound[name].write.parquet(f"{root}/{name}")
    return {
        n: spark.read.parquet(f"{root}/{n}")
        for n in ("encounter", "medical_claim", "calendar", "practitioner")
    }


def test_claim_filter_and_needed_columns_reach_the_scan(spark, stored_inputs):
    star = Star(stored_inputs, RUN_TS)
    encounters = star.input("encounter").select("encounter_id")
    plan = physical(encounters)
    assert "EqualTo(encounter_source_type,claim)" in plan
    assert "ReadSchema: struct<encounter_id:string,encounter_source_type:string>" in plan


def test_date_bounds_are_one_narrow_scan_pushed_into_the_calendar(spark, stored_inputs):
    star = Star(stored_inputs, RUN_TS)
    frame = dims.date(star.input("calendar"), star.input("medical_claim"))
    frame.collect()
    plan = physical(frame)
    assert "ReadSchema: struct<claim_start_date:date>" in plan
    assert plan.count("ReadSchema: struct<claim_start_date:date>") <= plan.count("Subquery")


def test_provider_scan_reads_five_columns(spark, stored_inputs):
    star = Star(stored_inputs, RUN_TS)
    plan = physical(star.table("dim_encounter_provider"))
    scan = next(line for line in plan.splitlines() if "rendering_npi:string" in line)
    read = scan[scan.index("ReadSchema") :]
    assert "struct<encounter_id:string,data_source:string,rendering_npi:string,paid_amount" in read
    assert "claim_id" not in read and "payer" not in read


@pytest.mark.parametrize("name", [*TABLES, *INTERMEDIATES])
def test_no_broadcast_is_forced(spark, settings, name):
    """Every broadcast is Spark's own decision by size; without it all joins are shuffled."""
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    plan = physical(Star(BoundInputs(spark, SF_DIR), RUN_TS).table(name))
    assert "Broadcast" not in plan


def test_dimension_joins_of_claims_are_broadcast_by_size(spark):
    plan = physical(registry.star(spark, SF_DIR).table("fact_claims"))
    assert "BroadcastHashJoin [service_category_1" in plan
    assert "BroadcastHashJoin [icd_10_code" in plan


def test_unused_provider_lookup_is_dropped(spark):
    """One provider per encounter is provable, so selecting nothing of it removes the branch."""
    star = Star(BoundInputs(spark, SF_DIR), RUN_TS)
    keys = star.table("encounter_enrichment").select("encounter_id", "data_source")
    assert "lineitem" not in keys._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("threshold", ["10MB", "100KB"])
def test_key_sets_do_not_shuffle_the_large_sides(spark, settings, threshold):
    """Encounters never move by their group or type, nor claim lines by their category."""
    settings({"spark.sql.autoBroadcastJoinThreshold": threshold})
    for name in ("fact_encounters", "encounter_enrichment", "fact_claims"):
        plan = physical(Star(BoundInputs(spark, "/root/testdata/sf0.1"), RUN_TS).table(name))
        assert "BroadcastHashJoin [encounter_group" in plan
        for line in plan.splitlines():
            if "Exchange hashpartitioning(encounter_group" in line:
                assert "o_orderpriority" in line or "encounter_group_sk" in line
            assert "SortMergeJoin [encounter_" not in line or "encounter_id" in line, line
            assert "SortMergeJoin [service_category" not in line
    uncovered = registry.queries()["uncovered_service_categories"](spark, "/root/testdata/sf0.1")
    assert "SortMergeJoin [service_category" not in physical(uncovered)


def test_a_key_set_beyond_its_bound_fails(spark):
    keys = spark.range(11).selectExpr("cast(id as string) as k", "nullif(id, 3) as v")
    assert sorted(bounded(keys, "keys", 11).collect(), key=str) == sorted(keys.collect(), key=str)
    assert bounded(keys, "keys", None) is keys
    assert bounded(keys.limit(0), "keys", 5).isEmpty()
    with pytest.raises(Exception, match="keys has more than 10 rows"):
        bounded(keys, "keys", 10).collect()


def test_drug_terminology_meets_the_lines_once(spark, settings):
    """Without broadcasts: one join by NDC, one by prescriber, the lines move once for each; rows as with them."""
    small = Star(BoundInputs(spark, SF_DIR), RUN_TS).table("fact_pharmacy_claims")
    expected = sorted(small.collect(), key=str)
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    large = Star(BoundInputs(spark, SF_DIR), RUN_TS).table("fact_pharmacy_claims")
    plan = physical(Star(BoundInputs(spark, SF_DIR), RUN_TS).table("fact_pharmacy_claims"))
    assert len(re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[ndc_code", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(ndc_code", plan)) == 2  # lines, terminology
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*prescribing_provider_id[^)]*)\)", plan)
    assert len(moved) == 2  # lines, practitioners
    assert sorted(large.collect(), key=str) == expected


def test_hot_drugs_and_lines_without_a_match_are_split(spark, settings):
    settings(SKEWED)
    lines = spark.range(0, 40_000, 1, 8).selectExpr(
        "case id % 3 when 0 then 'hot' when 1 then null else 'n' || id % 4000 end as ndc_code",
        "md5(cast(id as string)) as payload",
    )
    packages = spark.range(3000).selectExpr(
        "if(id = 0, 'hot', 'n' || id) as ndc11",
        "'d' || id % 50 as drug_id",
        "'p' || id as drug_name",
        "id % 2 = 0 as is_brand",
    )
    drugs = spark.range(50).selectExpr("'d' || id as drug_id", "'g' || id as drug_name", "true as is_brand")
    classes = spark.range(40).selectExpr("'d' || id as drug_id", "'a' as atc_1_name")
    split = facts.with_drugs(lines, packages, drugs, classes)
    found = sorted(split.collect(), key=str)
    assert "skew=true" in physical(split) or "skewed" in physical(split)
    settings({"spark.sql.autoBroadcastJoinThreshold": "10MB"})
    small = facts.with_drugs(lines, packages, drugs, classes)
    assert sorted(small.select(*split.columns).collect(), key=str) == found


SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
    "spark.sql.shuffle.partitions": "16",
}


def test_hot_encounter_is_split_next_to_an_aggregate(spark, settings):
    settings(SKEWED)
    claims = spark.range(0, 40_000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 'hot' else 'e' || id % 5000 end as encounter_id",
        "if(id >= 0, 'a', 'b') as data_source",
        "md5(cast(id as string)) as payload",
    )
    right = (
        spark.range(0, 5000, 1, 4)
        .selectExpr(
            "if(id = 0, 'hot', 'e' || id) as encounter_id",
            "if(id >= 0, 'a', 'b') as data_source",
            "id as v",
        )
        .groupBy("encounter_id", "data_source")
        .sum("v")
    )
    keys = ["encounter_id", "data_source"]
    plain = claims.join(right, keys)
    split = skew_splittable_join(claims, right, keys)
    assert split.columns == plain.columns
    assert sorted(split.collect()) == sorted(plain.collect())
    assert "skew=true" not in physical(plain) and "skewed" not in physical(plain)
    assert "skew=true" in physical(split) or "skewed" in physical(split)


def test_fact_claims_splits_a_hot_encounter(spark, settings, stored_inputs):
    """A third of all claim lines on one encounter of the real composition."""
    settings(SKEWED | {"spark.sql.autoBroadcastJoinThreshold": "10MB"})
    star = registry.star(spark, SF_DIR)
    enrichment = star.table("encounter_enrichment")
    hot = enrichment.filter("data_source = 'src_a'").agg({"encounter_id": "min"}).first()[0]
    claims = star.input("medical_claim").repartition(8).selectExpr(
        "* except (encounter_id, data_source)",
        f"case when claim_line_number <= 2 then '{hot}' else encounter_id end as encounter_id",
        "case when claim_line_number <= 2 then 'src_a' else data_source end as data_source",
    )
    fact = facts.claims(claims, star.table("dim_service_category"), enrichment)
    n = fact.filter(f"encounter_id = '{hot}'").count()
    fact.collect()
    assert n > fact.count() / 5
    assert "skew=true" in physical(fact)


def test_member_month_counts_are_splittable(spark, settings):
    """A placeholder member with a third of all months is joined in pieces."""
    settings(SKEWED)
    months = spark.range(0, 30_000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 'unknown' else 'p' || id % 4000 end as person_id",
        "cast(null as string) as member_id",
        "cast(id as string) as member_month_id",
        "'a' as data_source",
        "'2024' as year_nbr",
        "repeat(md5(cast(id as string)), 2) as pad",
    )
    year = ["person_id", "member_id", "data_source", "year_nbr"]
    counts = months.groupBy(*year).count()
    joined = left_join_null_safe(months, counts, plain=[], null_safe=year)
    joined.collect()
    assert joined.filter("person_id = 'unknown' and count <> 10000").isEmpty()
    assert joined.count() == 30_000
    assert "skew=true" in physical(joined)


def moved(frame) -> list[str]:
    """The columns of every exchange of the plan that Spark starts with."""
    plan = frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return re.findall(r"\) Exchange\s+Input \[\d+\]: \[(.*?)\]\n", plan)


def month_inputs(spark, hot=False):
    """Months, scores and costs; hot: a third of all months are one person's, of one month and payer."""
    third = "id % 3 = 0" if hot else "false"
    keys = [
        f"if({third}, 'unknown', 'p' || id % 4000) as person_id",
        f"if({third} or id % 5 = 0, null, 'm' || id % 7) as member_id",
        f"if({third}, '202401', concat('2024', lpad(cast(1 + id % 12 as string), 2, '0'))) as year_month",
        "'a' as data_source",
        f"if({third} or id % 2 = 1, null, 'x') as payer",
        "'y' as plan",
    ]
    ids = spark.range(0, 30_000 if hot else 3000, 1, 8)
    months = ids.selectExpr(
        *keys, "cast(id as string) as member_month_id", "'2024' as year_nbr", "timestamp_seconds(id) as last_run_ts",
        "repeat(md5(cast(id as string)), 2) as pad",
    )
    scores = spark.range(4000).selectExpr(
        "'p' || id as person_id", "'a' as data_source", "if(id % 2 = 0, 'x', null) as payer",
        "make_date(2024, cast(1 + id % 12 as int), 28) as collection_end_date",
        "cast(id % 9 as decimal(18,2)) as normalized_risk_score", "'v' as risk_model_code",
    )
    amounts = [f"cast(1 as decimal(18,2)) as {c}" for c in COST_MEASURES]
    costs = spark.range(3000).selectExpr(*keys, *amounts)
    return months, scores, costs.dropDuplicates(["person_id", "member_id", "year_month", "payer"])


def test_whole_months_move_twice(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "500"})
    months = facts.member_months(*month_inputs(spark))
    assert sum("last_run_ts" in columns for columns in moved(months)) == 2
    wide = [columns for columns in moved(months) if COST_MEASURES[0] in columns]
    assert len(wide) == 1 and "member_month_id" not in wide[0]  # costs move once, apart from months


def test_scores_do_not_move_for_their_means(spark, settings):
    _, scores, _ = month_inputs(spark)
    assert not any("person_id" in columns for columns in moved(enrich.monthly_risk(scores)))
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    shuffled = enrich.monthly_risk(scores, mean_rows=None)
    assert any("person_id" in columns for columns in moved(shuffled))
    assert sorted(shuffled.collect(), key=str) == sorted(enrich.monthly_risk(scores).collect(), key=str)
    with pytest.raises(Exception, match="more than 3 rows"):
        enrich.monthly_risk(scores, mean_rows=3).collect()


def test_months_of_a_hot_member_are_split(spark, settings):
    settings(SKEWED)
    months = facts.member_months(*month_inputs(spark, hot=True))
    frame = months.select("person_id", "total_year_months", "member_month_id", COST_MEASURES[0])
    rows = frame.collect()
    assert "skew=true" in physical(frame)
    hot = [r for r in rows if r["person_id"] == "unknown"]
    assert len(hot) == 10_000 and {r["total_year_months"] for r in hot} == {10_000}
    assert len({r["member_month_id"] for r in rows}) == 30_000


def test_empty_inputs_give_empty_tables(spark):
    from claimstar.sources.contracts import CONTRACTS

    empty = {name: spark.createDataFrame([], schema(name)) for name in CONTRACTS}
    star = Star(empty, RUN_TS)
    for name in (*TABLES, *INTERMEDIATES):
        assert star.table(name).isEmpty(), name


def test_costs_are_summed_before_their_texts_are_made(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "500"})
    plan = physical(BoundInputs(spark, SF_DIR)["cost"])
    keys = re.findall(r"HashAggregate\(keys=\[(.*?)\], functions", plan)
    assert keys and not any("person_id" in k for k in keys)
    assert not re.search(r"Exchange hashpartitioning\(person_id", plan)


def test_costs_of_customers_that_differ_in_what_no_text_shows(spark):
    tables = {
        "customer": spark.createDataFrame(
            [(7, "MACHINERY", 1), (7, None, 5), (7, "HOUSEHOLD", 1), (7, "HOUSEHOLD", 2), (8, "BUILDING", None)],
            "c_custkey long, c_mktsegment string, c_nationkey int",
        ),
        "orders": spark.createDataFrame(
            [(1, 7, "1995-01-03", 10.5), (3, 7, "1995-01-20", 2.25), (None, 7, "1995-01-31", 1.0),
             (2, 7, "1995-01-20", 4.0), (5, 8, None, 3.0), (5, 8, None, None), (-1, 8, None, 8.0), (1, None, None, 1.0)],
            "o_orderkey long, o_custkey long, o_orderdate string, o_totalprice double",
        ).withColumn("o_orderdate", F.col("o_orderdate").cast("date")),
    }
    binding = BINDINGS["cost"]
    plain = replace(binding, rows=ORDERS)
    found, wanted = (_bind(b, tables.__getitem__) for b in (binding, plain))
    assert found.schema == wanted.schema
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert found.count() == 5


def test_cells_do_not_move_with_their_own_columns(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "500"})
    months = facts.member_months(*month_inputs(spark))
    assert not any("cell" in columns and "person_id" in columns for columns in moved(months))


def test_texts_of_raw_lines_are_made_in_as_many_tasks_as_spark_shuffles_to(spark, settings):
    settings({"spark.sql.shuffle.partitions": "7"})
    for name in ("medical_claim", "pharmacy_claim"):
        lines = bind_raw(spark, SF_DIR, name)
        assert lines.select(F.spark_partition_id()).distinct().count() == 7


def test_portable_rounds_only_what_has_more_decimals(spark):
    values = ["0.1", "-0.07", "1234567890123456.78", "-9999999999999999.99", "0.00", None]
    frame = spark.createDataFrame([(v,) for v in values], "v string").selectExpr(
        "cast(v as decimal(18,2)) as two", "cast(v as decimal(38,8)) + 0.00000051BD as eight",
        "cast(v as double) / 3 as paid", "cast(v as decimal(24,6)) as six",
    )
    found = registry.portable(frame)
    assert found.collect() == frame.select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in frame.columns]).collect()
    assert physical(found).count("round(") == 2
