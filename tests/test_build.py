"""A full rebuild stores what the lazily composed tables compute."""

from pathlib import Path

import pytest
from conftest import RUN_TS, SF_DIR

from claimstar.operators import quality
from claimstar.plans.star import TABLES, RulesViolated, Star, build
from claimstar.sources.contracts import CONTRACTS
from claimstar.sources.sinks import ParquetSink, TableSink
from claimstar_oracle.binding import BoundInputs


def lazy(spark):
    return Star(BoundInputs(spark, SF_DIR), run_ts=RUN_TS)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    sink = ParquetSink(
        str(tmp_path_factory.mktemp("star")), "v1_", {"fact_claims": ["year_month"]}
    )
    star = lazy(spark)
    return sink, star, build(spark, star, sink)


def test_build_returns_all_tables(built):
    assert tuple(built[2]) == TABLES


@pytest.mark.parametrize("name", TABLES)
def test_stored_equals_lazy(spark, built, name):
    stored, expected = built[2][name], lazy(spark).table(name)
    assert stored.columns == expected.columns
    assert stored.dtypes == expected.dtypes
    assert stored.count() == expected.count()
    assert stored.exceptAll(expected).isEmpty()


def test_partitioned_fact_has_one_folder_per_month(spark, built):
    sink, _, tables = built
    path = sink.location(spark, "fact_claims")
    assert path.startswith(sink.path("fact_claims") + "/") and "/v1_fact_claims/" in path
    month = tables["fact_claims"].first()["year_month"]
    pruned = spark.read.parquet(path).filter(f"year_month = '{month}'")
    assert 0 < len(pruned.inputFiles()) <= 4 * 200
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_rules_hold_on_the_stored_star_except_the_known_ones(built):
    _, star, tables = built

    def resolve(name):
        if name in CONTRACTS:
            return star.input(name)
        return tables[name] if name in tables else star.table(name)  # intermediates are not stored

    failed = quality.run(resolve).filter("violations > 0")
    assert {(r.check_name, r.table_name, r.column_names) for r in failed.collect()} == {
        ("not_null", "dim_encounter_provider", "encounter_id"),
    }


def test_partial_build_into_bucketed_catalog_tables(spark):
    spark.sql("create database if not exists marts")
    sink = TableSink(
        "marts", bucket_by={"fact_encounters": (4, ["encounter_id", "data_source"])}
    )
    names = ["fact_encounters", "fact_ed_visits"]
    tables = build(spark, lazy(spark), sink, names)
    assert list(tables) == names
    counts = tables["fact_encounters"].groupBy("encounter_id", "data_source").count()
    assert "Exchange hashpartitioning" not in (
        counts._jdf.queryExecution().executedPlan().toString()
    )
    again = build(spark, lazy(spark), sink, names)
    assert again["fact_ed_visits"].count() == lazy(spark).table("fact_ed_visits").count()


def test_unknown_table_is_refused(spark):
    with pytest.raises(KeyError):
        build(spark, lazy(spark), ParquetSink("/nowhere"), ["fact_conditions"])
    with pytest.raises(KeyError):
        lazy(spark).table("fact_conditions")


def test_a_broken_rule_stops_the_build(spark, tmp_path):
    names = ["dim_data_source", "dim_encounter_provider", "dim_member"]
    sink = ParquetSink(str(tmp_path))
    with pytest.raises(RulesViolated) as stopped:
        build(spark, lazy(spark), sink, names, quality.RULES)
    broken = stopped.value.violations
    assert list(broken) == [("not_null", "dim_encounter_provider", "encounter_id")]
    assert list(broken.values())[0] > 0
    assert not (tmp_path / "dim_member").exists()  # what follows is not built
    kept = [r for r in quality.RULES if r.table != "dim_encounter_provider"]
    assert list(build(spark, lazy(spark), sink, names, kept)) == names


class Breaks:
    """A sink that fails at its second table."""

    def __init__(self, sink):
        self.sink, self.writes = sink, 0

    def write(self, name, frame):
        self.writes += 1
        if self.writes == 2:
            raise RuntimeError("lost")
        self.sink.write(name, frame)

    def read(self, spark, name, like):
        return self.sink.read(spark, name, like)


@pytest.mark.parametrize("kind", ["folders", "catalog"])
def test_a_build_can_be_repeated(spark, tmp_path, kind):
    if kind == "folders":
        sink = ParquetSink(str(tmp_path))
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS repeated")
        sink = TableSink("repeated", "r_")
    star, names = lazy(spark), ["dim_member", "dim_service_category"]
    first = {n: f.count() for n, f in build(spark, star, sink, names).items()}
    with pytest.raises(RuntimeError):
        build(spark, star, Breaks(sink), names)
    again = build(spark, star, sink, names)
    assert {n: f.count() for n, f in again.items()} == first


class Crash(Exception):
    pass


def crash(*_):
    raise Crash


def versions(spark, sink, name):
    if isinstance(sink, ParquetSink):
        return [p for p in Path(sink.path(name)).iterdir() if p.is_dir()]
    return sink._versions(spark, name)


@pytest.mark.parametrize("kind", ["folders", "catalog"])
@pytest.mark.parametrize("step", ["switch", "write"])
def test_a_failed_write_leaves_the_old_table(spark, tmp_path, monkeypatch, kind, step):
    if kind == "folders":
        sink = ParquetSink(str(tmp_path), "s_")
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS crashes")
        sink = TableSink("crashes", f"{step}_")
    old, new = spark.range(5), spark.range(7)
    sink.write("t", old)
    reader = sink.read(spark, "t", old)
    if step == "switch":
        monkeypatch.setattr(type(sink), "_switch", crash)
        with pytest.raises(Crash):
            sink.write("t", new)
        monkeypatch.undo()
    else:
        with pytest.raises(Exception, match="no more"):
            sink.write("t", new.selectExpr("if(id = 6, raise_error('no more'), id) as id"))
    assert sink.read(spark, "t", old).count() == 5
    assert len(versions(spark, sink, "t")) == 1  # the failed one is gone
    sink.write("t", new)
    assert sink.read(spark, "t", old).count() == 7
    assert reader.count() == 5  # a query over the version before goes on
    for n in (8, 9):
        sink.write("t", spark.range(n))
    assert sink.read(spark, "t", old).count() == 9 and len(versions(spark, sink, "t")) == 2


def test_a_table_without_a_version_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ParquetSink(str(tmp_path)).read(spark, "t", spark.range(1))


def test_null_rules_are_counted_while_the_table_is_written(spark, tmp_path, monkeypatch):
    names = ["dim_member", "dim_encounter_provider"]
    rules = [r for r in quality.RULES if r.check == "not_null" and r.table in names]
    monkeypatch.setattr(quality, "run", crash)  # no check reads a stored table again
    with pytest.raises(RulesViolated) as stopped:
        build(spark, lazy(spark), ParquetSink(str(tmp_path)), names, rules)
    wanted = lazy(spark).table("dim_encounter_provider").filter("encounter_id is null").count()
    assert stopped.value.violations == {("not_null", "dim_encounter_provider", "encounter_id"): wanted}


def test_coverage_is_part_of_a_build(spark, tmp_path):
    names = ["dim_encounter_group", "dim_encounter_type", "dim_service_category", "fact_encounters"]
    broken = {}
    for check in quality.COVERAGE:
        try:
            build(spark, lazy(spark), ParquetSink(f"{tmp_path}/{check}"), names, coverage=[check])
        except RulesViolated as stopped:
            broken |= stopped.violations
    wanted = {}
    for check, (table, uncovered) in quality.COVERAGE.items():
        n = uncovered(lazy(spark).resolve).count()
        if n:
            wanted["coverage", table, check] = n
    assert broken == wanted and wanted
    with pytest.raises(KeyError):
        build(spark, lazy(spark), ParquetSink(str(tmp_path)), names, coverage=["check_nothing"])
