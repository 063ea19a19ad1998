"""Table-quality checks as Spark jobs: each gives the number of violations, zero means passed."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstar.functions.joins import KEY_ROWS, bounded, union_all
from claimstar.operators.dims import CATEGORY_LEVELS, known_sources
from claimstar.operators.facts import ENCOUNTER_KEY
from claimstar.sources import seeds

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Rule:
    """A check of ``columns`` of ``table``.

    check: not_null, unique, unique_combination, relationship (to ``parent``, its first column
    being the key) or accepted_values (the ``values``).
    """

    check: str
    table: str
    columns: tuple[str, ...]
    parent: tuple[str, str] | None = None
    values: tuple[str, ...] = ()


def _rules() -> tuple[Rule, ...]:
    # Which columns of which table must hold what.
    not_null = {
        "dim_data_source": ["data_source_sk", "data_source"],
        "dim_date": ["full_date"],
        "dim_encounter_group": ["encounter_group_sk", "encounter_group"],
        "dim_encounter_provider": ["encounter_id", "data_source"],
        "dim_encounter_type": ["encounter_type_sk", "encounter_type"],
        "dim_member": ["person_sk"],
        "dim_member_months": ["member_month_id"],
        "dim_service_category": ["service_category_sk"],
        "fact_admissions": ["encounter_id", "data_source"],
        "fact_claims": ["medical_claim_id", "service_category_sk"],
        "fact_hcc_gaps": ["data_source"],
        "fact_member_months": ["member_month_id"],
        "fact_pharmacy_claims": ["pharmacy_claim_id"],
        "fact_quality_measures": ["data_source"],
        "fact_risk_factors": ["data_source"],
        "fact_risk_scores": ["data_source"],
        "member_month_risk": ["member_month_id", "data_source"],
        "encounter_group_keys": ["encounter_group", "encounter_group_sk"],
        "encounter_type_keys": ["encounter_type", "encounter_type_sk", "encounter_group_sk"],
    }
    unique = {
        "dim_data_source": ["data_source_sk", "data_source"],
        "dim_date": ["full_date"],
        "dim_encounter_group": ["encounter_group_sk", "encounter_group"],
        "dim_encounter_type": ["encounter_type_sk", "encounter_type"],
        "dim_member": ["person_sk"],
        "dim_member_months": ["member_month_id"],
        "dim_service_category": ["service_category_sk"],
        "fact_member_months": ["member_month_id"],
        "encounter_group_keys": ["encounter_group", "encounter_group_sk"],
        "encounter_type_keys": ["encounter_type", "encounter_type_sk"],
    }
    combinations = {
        "dim_encounter_provider": "encounter_id data_source",
        "dim_member": "person_id data_source",
        "fact_admissions": "encounter_id data_source pqi_number",
        "fact_claims": "medical_claim_id data_source",
        "fact_ed_visits": "encounter_id data_source",
        "fact_encounter_service_bridge": "encounter_id data_source service_category_sk",
        "fact_encounters": "encounter_id data_source",
        "fact_hcc_gaps": "person_id payer data_source model_version hcc_code",
        "fact_pharmacy_claims": "pharmacy_claim_id data_source",
        "fact_quality_measures": (
            "person_id data_source measure_id measure_version"
            " performance_period_begin performance_period_end"
        ),
        "fact_risk_factors": (
            "person_id payer data_source factor_type risk_factor_description"
            " model_version payment_year"
        ),
        "fact_risk_scores": "person_id payer data_source payment_year",
        "readmissions": "encounter_id data_source",
        "encounter_enrichment": "encounter_id data_source",
        "member_month_risk": "member_month_id data_source",
    }
    relationships = [
        ("dim_encounter_type", "encounter_group_sk", "dim_encounter_group"),
        ("fact_claims", "member_month_id", "dim_member_months"),
        ("fact_claims", "service_category_sk", "dim_service_category"),
        ("fact_encounters", "encounter_group_sk", "dim_encounter_group"),
        ("fact_encounters", "encounter_type_sk", "dim_encounter_type"),
        ("fact_member_months", "member_month_id", "dim_member_months"),
        ("fact_pharmacy_claims", "member_month_id", "dim_member_months"),
        ("encounter_type_keys", "encounter_group_sk", "encounter_group_keys"),
    ]
    rules = [Rule("not_null", t, (c,)) for t, columns in not_null.items() for c in columns]
    rules += [Rule("unique", t, (c,)) for t, columns in unique.items() for c in columns]
    rules += [Rule("unique_combination", t, tuple(c.split())) for t, c in combinations.items()]
    rules += [Rule("relationship", t, (c,), parent=(p, c)) for t, c, p in relationships]
    rules.append(
        Rule(
            "accepted_values",
            "fact_pharmacy_claims",
            ("brand_vs_generic",),
            values=("brand", "generic"),
        )
    )
    return tuple(rules)


RULES = _rules()


def duplicates(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; nulls of a combination group together."""
    keys = frame.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else frame
    return keys.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child values without a parent, with their number of rows.

    Child values are counted first, so a hot key reaches the join as one row.
    """
    counted = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(F.col(parent_column).alias(column))
    return counted.join(parents, column, "left_anti")


def unaccepted(frame: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct non-null values outside the accepted ones, with their number of rows."""
    others = frame.filter(~F.col(column).isin(*values))
    return others.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def _result(check: str, table: str, columns: Column, violations: Column) -> list[Column]:
    return [
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        columns.alias("column_names"),
        violations.alias("violations"),
    ]


def _count_rows(rule: Rule, broken: DataFrame) -> DataFrame:
    names = F.lit(",".join(rule.columns))
    return broken.agg(*_result(rule.check, rule.table, names, F.count(F.lit(1))))


def _null_counts(table: str, frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null counts of several columns in one pass, one result row per column."""
    counted = [
        f"struct('not_null' as check_name, '{table}' as table_name, '{c}' as column_names,"
        f" count_if(`{c}` is null) as violations)"
        for c in columns
    ]
    return frame.agg(F.expr(f"array({', '.join(counted)}) as counts")).selectExpr("inline(counts)")


def _key(rule: Rule) -> Column:
    """The rule's key as exact text; null where the rule does not apply.

    Every value comes with its length, so neither a null nor a value that looks like two can be taken
    for another key.
    """
    values = [F.col(c).cast("string") for c in rule.columns]
    sized = [F.coalesce(F.concat(F.length(v), F.lit(":"), v), F.lit("-")) for v in values]
    key = F.concat(*sized)
    return F.when(F.col(rule.columns[0]).isNotNull(), key) if len(rule.columns) == 1 else key


def _key_hash(rule: Rule) -> Column:
    """64 bits of the rule's key; null where the rule does not apply."""
    parts = [F.col(c).cast("string") for c in rule.columns]
    if len(parts) == 1:
        return F.when(parts[0].isNotNull(), F.xxhash64(*parts))
    return F.xxhash64(*parts, *[p.isNull() for p in parts])


def _shown(rule: Rule) -> Column:
    """The rule's key as it is reported: values joined by |, null ones as \\N."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in rule.columns])


def _pairs(frame: DataFrame, rules: Sequence[Rule], value: Callable[[Rule], Column]) -> DataFrame:
    """(rule, key) of every row and rule that applies; the table is computed once.

    The number of an only rule is a constant, which groups and moves with nothing.
    """
    if len(rules) == 1:
        pairs = frame.select(F.lit(0).alias("rule"), value(rules[0]).alias("key"))
        return pairs.filter("key is not null")
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rule"), value(r).alias("key")) for n, r in enumerate(rules)]
    )
    pairs = frame.select(F.explode(pairs).alias("pair")).select("pair.*")
    return pairs.filter("key is not null")


def _counts_of(found: DataFrame, rules: Sequence[Rule], number: Callable[[int], str]) -> DataFrame:
    """One result row per rule: a number over the rows found, which carry the number of their rule."""
    counted = [
        f"struct('{r.check}' as check_name, '{r.table}' as table_name,"
        f" '{','.join(r.columns)}' as column_names, {number(n)} as violations)"
        for n, r in enumerate(rules)
    ]
    return found.agg(F.expr(f"array({', '.join(counted)}) as counts")).selectExpr("inline(counts)")


def _of_rule(n: int) -> str:
    return f"count_if(rule = {n})"


def _repeated_probes(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """How many keys of each single-column rule, and key hashes of each other rule, occur again.

    Of keys of several columns, a hash and a count move a row, however long they are.
    """
    parts = [part for part, single in (("hash", False), ("text", True)) if any((len(r.columns) == 1) == single for r in rules)]

    def probe(rule: Rule) -> Column:
        single = len(rule.columns) == 1
        text = F.col(rule.columns[0]).cast("string") if single else F.lit(None).cast("string")
        number = F.lit(None).cast("long") if single else _key_hash(rule)
        known = text.isNotNull() if single else F.lit(True)
        given = {"hash": number, "text": text}
        return F.when(known, F.struct(*[given[part].alias(part) for part in parts]))

    probes = _pairs(frame, rules, probe).groupBy("rule", *[f"key.{part}" for part in parts])
    counted = probes.agg(F.count("*").alias("n_rows"))
    return _counts_of(counted.filter("n_rows > 1"), rules, _of_rule)


def _repeated_keys(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, key, shown, n_rows) of all keys that occur more than once, by the exact keys."""
    both = lambda r: F.when(_key(r).isNotNull(), F.struct(_key(r).alias("exact"), _shown(r).alias("shown")))
    pairs = _pairs(frame, rules, both)
    counted = pairs.groupBy("rule", F.col("key.exact").alias("key"))
    counted = counted.agg(F.first("key.shown").alias("shown"), F.count("*").alias("n_rows"))
    return counted.filter("n_rows > 1")


def _by_table(rules: Iterable[Rule], *checks: str) -> dict[str, list[Rule]]:
    grouped: dict[str, list[Rule]] = {}
    for rule in rules:
        if rule.check in checks:
            grouped.setdefault(rule.table, []).append(rule)
    return grouped


UNIQUENESS = ("unique", "unique_combination")


def probed(tables: Tables, rules: Iterable[Rule]) -> dict[Rule, int]:
    """Per uniqueness rule how many of its keys repeat; of keys of several columns, how many hashes.

    A rule none of whose hashes repeats holds. One job over all tables, started here; a row per rule
    comes back.
    """
    grouped = _by_table(rules, *UNIQUENESS)
    if not grouped:
        return {}
    counts = union_all([_repeated_probes(tables(t), same) for t, same in grouped.items()])
    found = {(r.check_name, r.table_name, r.column_names): r.violations for r in counts.collect()}
    listed = [r for same in grouped.values() for r in same]
    return {r: found[r.check, r.table, ",".join(r.columns)] for r in listed}


def _doubtful(counts: dict[Rule, int]) -> list[Rule]:
    return [r for r, n in counts.items() if n and len(r.columns) > 1]


def _duplicate_counts(tables: Tables, rules: Sequence[Rule]) -> list[DataFrame]:
    """Duplicate keys in two steps: rules with hashes that repeat are counted again, by whole keys."""
    counts = probed(tables, rules)
    doubtful = _doubtful(counts)
    certain = [r for r in counts if r not in doubtful]
    results = []
    if certain:
        nothing = tables(certain[0].table).sparkSession.range(0)
        number = lambda n: f"cast({counts[certain[n]]} as bigint)"
        results.append(_counts_of(nothing, certain, number))
    for table, same in _by_table(doubtful, *UNIQUENESS).items():
        results.append(_counts_of(_repeated_keys(tables(table), same), same, _of_rule))
    return results


def _orphan_keys(frame: DataFrame, rules: Sequence[Rule], tables: Tables) -> DataFrame:
    """(rule, key, n_rows) of child keys without a parent, for several rules in one pass over the table.

    Child keys are counted as (rule, key) pairs, which shrink in each task before they move, and
    meet the keys of all parents at once.
    """
    pairs = _pairs(frame, rules, lambda r: F.col(r.columns[0]).cast("string"))
    counted = pairs.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n_rows"))
    rules_of: dict[tuple[str, str], list[int]] = {}
    for n, r in enumerate(rules):
        rules_of.setdefault(r.parent, []).append(n)
    parents = [
        tables(parent).select(
            F.explode(F.array(*map(F.lit, numbers))).alias("rule"),
            F.col(column).cast("string").alias("key"),
        )
        for (parent, column), numbers in rules_of.items()
    ]
    return counted.join(union_all(parents), ["rule", "key"], "left_anti")


def _orphan_counts(frame: DataFrame, rules: Sequence[Rule], tables: Tables) -> DataFrame:
    rows_of = lambda n: f"coalesce(sum(if(rule = {n}, n_rows, null)), 0)"
    return _counts_of(_orphan_keys(frame, rules, tables), rules, rows_of)


def _named(found: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """Found keys, which carry the number of their rule, in the shape of ``violating_keys``."""
    names = [
        F.struct(
            F.lit(r.check).alias("check_name"),
            F.lit(r.table).alias("table_name"),
            F.lit(",".join(r.columns)).alias("column_names"),
        )
        for r in rules
    ]
    named = found.withColumn("named", F.get(F.array(*names), F.col("rule")))
    return named.select("named.*", F.col(key).alias("key"), "n_rows")


def violations(tables: Tables, rule: Rule) -> DataFrame:
    """What breaks a rule: rows with a null, repeated keys, keys without a parent, other values.

    Keys come with their number of rows, ``n_rows``.
    """
    frame = tables(rule.table)
    if rule.check == "not_null":
        return frame.filter(F.col(rule.columns[0]).isNull())
    if rule.check in ("unique", "unique_combination"):
        return duplicates(frame, rule.columns)
    if rule.check == "relationship":
        parent, key = rule.parent
        return orphans(frame, rule.columns[0], tables(parent), key)
    if rule.check == "accepted_values":
        return unaccepted(frame, rule.columns[0], rule.values)
    raise ValueError(f"unknown check {rule.check}")


def violating_keys(tables: Tables, rules: Iterable[Rule]) -> DataFrame:
    """The violations of several rules in one shape: check_name, table_name, column_names, key, n_rows.

    The key is that of the rule as text, null parts written as \\N; rows with a null come as a number.
    Rules of one kind and table share one pass, and rules of several columns that ``probed`` clears
    need none beyond its own.
    """
    rules = list(rules)
    found = []
    for table, same in _by_table(rules, "not_null").items():
        nulls = _null_counts(table, tables(table), [r.columns[0] for r in same])
        nulls = nulls.filter("violations > 0").withColumnRenamed("violations", "n_rows")
        found.append(nulls.withColumn("key", F.lit("\\N")))
    whole = [r for r in rules if len(r.columns) == 1]
    whole += _doubtful(probed(tables, [r for r in rules if len(r.columns) > 1]))
    for table, same in _by_table(whole, *UNIQUENESS).items():
        found.append(_named(_repeated_keys(tables(table), same), same, "shown"))
    for table, same in _by_table(rules, "relationship").items():
        found.append(_named(_orphan_keys(tables(table), same, tables), same, "key"))
    for rule in rules:
        if rule.check == "accepted_values":
            others = violations(tables, rule).withColumn("rule", F.lit(0))
            found.append(_named(others, [rule], rule.columns[0]))
    columns = ["check_name", "table_name", "column_names", "key", "n_rows"]
    if not found:
        spark = tables(rules[0].table).sparkSession
        empty = "check_name string, table_name string, column_names string, key string, n_rows long"
        return spark.createDataFrame([], empty)
    return union_all([f.select(*columns) for f in found])


def run(tables: Tables, rules: Iterable[Rule] = RULES) -> DataFrame:
    """One row per rule: check_name, table_name, column_names, violations.

    ``tables`` maps a name to a DataFrame, best to a stored table. All null checks of a table
    share one scan, and so do all its uniqueness checks and all its relationships. Uniqueness is counted
    by a job of its own (``probed``), and again by whole keys where hashes of several columns repeat.
    """
    rules = list(rules)
    for rule in rules:
        if rule.check not in ("not_null", *UNIQUENESS, "relationship", "accepted_values"):
            raise ValueError(f"unknown check {rule.check}")
    results = _duplicate_counts(tables, rules)
    for table, same in _by_table(rules, "not_null").items():
        results.append(_null_counts(table, tables(table), [r.columns[0] for r in same]))
    for table, same in _by_table(rules, "relationship").items():
        results.append(_orphan_counts(tables(table), same, tables))
    for rule in rules:
        if rule.check == "accepted_values":
            results.append(_count_rows(rule, violations(tables, rule)))
    return union_all(results)


def null_metrics(rules: Iterable[Rule]) -> dict[Rule, Column]:
    """The null counts of not_null rules as aggregates, to be observed while a table is written."""
    return {
        r: F.count_if(F.col(r.columns[0]).isNull()) for r in rules if r.check == "not_null"
    }


def uncovered_labels(encounter: DataFrame, dimension: DataFrame, column: str) -> DataFrame:
    """Distinct non-null labels of claim encounters that the dimension does not map."""
    labels = encounter.select(column).filter(F.col(column).isNotNull()).distinct()
    return labels.join(dimension.select(column), column, "left_anti")


def counted(check: str, violations: DataFrame) -> DataFrame:
    """A check given by its violating rows, as one row: check_name, violations."""
    return violations.agg(
        F.lit(check).alias("check_name"), F.count(F.lit(1)).alias("violations")
    )


def missing_keys(dimension: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows of ``expected`` that the dimension does not hold exactly."""
    return expected.join(dimension.select(*expected.columns), expected.columns, "left_anti")


def uncovered_service_categories(
    medical_claim: DataFrame,
    fact_encounters: DataFrame,
    dim_service_category: DataFrame,
    dim_data_source: DataFrame | None = None,
    key_rows: int | None = KEY_ROWS,
) -> DataFrame:
    """Category combinations of otherwise publishable claims that the dimension lacks.

    The few unmapped lines are singled out, and made distinct per encounter, before anything is
    shuffled for the test of being publishable.
    """
    levels = list(CATEGORY_LEVELS)
    mapped = bounded(dim_service_category.select(*levels), "dim_service_category", key_rows)
    complete = medical_claim.filter(F.col("enrollment_flag") == 1).dropna(subset=levels)
    unmapped = (
        known_sources(complete, dim_data_source)
        .join(mapped, levels, "left_anti")
        .select(*ENCOUNTER_KEY, *levels)
        .distinct()
    )
    published = fact_encounters.select(*ENCOUNTER_KEY)
    return unmapped.join(published, list(ENCOUNTER_KEY), "left_semi").select(*levels).distinct()


def _labels(table: str, column: str) -> Callable[[Tables], DataFrame]:
    return lambda tables: uncovered_labels(tables("encounter"), tables(table), column)


def _fixed_type_keys(tables: Tables) -> DataFrame:
    types = tables("dim_encounter_type")
    return missing_keys(types, seeds.fixed_type_keys(types.sparkSession))


def _service_categories(tables: Tables) -> DataFrame:
    return uncovered_service_categories(
        tables("medical_claim"), tables("fact_encounters"), tables("dim_service_category")
    )


# What must be covered, the last table that each assertion needs, and the rows that break it.
COVERAGE: dict[str, tuple[str, Callable[[Tables], DataFrame]]] = {
    "check_encounter_group_coverage": (
        "dim_encounter_group",
        _labels("dim_encounter_group", "encounter_group"),
    ),
    "check_encounter_type_coverage": (
        "dim_encounter_type",
        _labels("dim_encounter_type", "encounter_type"),
    ),
    "check_fixed_type_keys": ("dim_encounter_type", _fixed_type_keys),
    "check_service_category_coverage": ("fact_encounters", _service_categories),
}
