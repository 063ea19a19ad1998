"""The star schema as lazily composed tables, and the full rebuild that stores them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession

from claimstar.functions.joins import KEY_ROWS
from claimstar.operators import dims, enrich, facts, quality
from claimstar.sources.contracts import CONTRACTS
from claimstar.sources.inputs import stage

# Published tables in an order in which every table follows the ones it reads.
TABLES = (
    "dim_data_source",
    "dim_date",
    "dim_encounter_group",
    "dim_encounter_type",
    "dim_encounter_provider",
    "dim_member",
    "dim_member_months",
    "dim_service_category",
    "fact_encounters",
    "fact_claims",
    "fact_encounter_service_bridge",
    "fact_admissions",
    "fact_ed_visits",
    "fact_hcc_gaps",
    "fact_member_months",
    "fact_pharmacy_claims",
    "fact_quality_measures",
    "fact_risk_factors",
    "fact_risk_scores",
)
INTERMEDIATES = ("encounter_enrichment", "member_month_risk")


def now_utc() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


class Star:
    """Tables over a set of inputs. Nothing runs until a returned DataFrame is used.

    ``stored`` holds tables that were already written; whatever reads them then starts from
    storage instead of recomputing them. ``key_rows`` bounds the value sets of encounter groups,
    encounter types and service categories (see ``functions.joins.bounded``); with None the means of
    monthly scores are not taken as small either.
    """

    def __init__(
        self,
        inputs: Mapping[str, DataFrame],
        run_ts: str | None = None,
        specialty_threshold: float = facts.DEFAULT_SPECIALTY_THRESHOLD,
        stored: Mapping[str, DataFrame] | None = None,
        key_rows: int | None = KEY_ROWS,
    ):
        self.inputs = inputs
        self.run_ts = run_ts or now_utc()
        self.specialty_threshold = specialty_threshold
        self.stored = dict(stored or {})
        self.key_rows = key_rows
        self._staged: dict[str, DataFrame] = {}
        self._composed: dict[str, DataFrame] = {}

    def input(self, name: str) -> DataFrame:
        """Staged input relation."""
        if name not in self._staged:
            self._staged[name] = stage(name, self.inputs[name], self.run_ts)
        return self._staged[name]

    def table(self, name: str) -> DataFrame:
        """Published or intermediate table."""
        if name in self.stored:
            return self.stored[name]
        if name not in TABLES and name not in INTERMEDIATES:
            raise KeyError(name)
        if name not in self._composed:
            self._composed[name] = getattr(self, f"_{name}")()
        return self._composed[name]

    def forget(self) -> None:
        """Compose tables anew from now on, so that they start from what is stored by then."""
        self._composed.clear()

    def resolve(self, name: str) -> DataFrame:
        """A published or intermediate table or a staged input, whichever has the name."""
        return self.input(name) if name in CONTRACTS else self.table(name)

    def _dim_data_source(self) -> DataFrame:
        return dims.data_source(
            self.input("eligibility"),
            self.input("medical_claim"),
            self.input("pharmacy_claim"),
            self.run_ts,
        )

    def _dim_date(self) -> DataFrame:
        return dims.date(self.input("calendar"), self.input("medical_claim"))

    def _dim_encounter_group(self) -> DataFrame:
        return dims.encounter_group(self.input("encounter_group_keys"), self.run_ts)

    def _dim_encounter_type(self) -> DataFrame:
        return dims.encounter_type(self.input("encounter_type_keys"), self.run_ts)

    def _dim_encounter_provider(self) -> DataFrame:
        return dims.encounter_provider(self.input("medical_claim"), self.input("practitioner"))

    def _dim_member(self) -> DataFrame:
        return dims.member(self.input("patient"))

    def _dim_member_months(self) -> DataFrame:
        return dims.member_months(self.input("member_month"))

    def _dim_service_category(self) -> DataFrame:
        return dims.service_category(self.input("service_categories"), self.run_ts)

    def _encounter_enrichment(self) -> DataFrame:
        providers = self.stored.get("dim_encounter_provider")
        if providers is None:
            providers = dims.encounter_provider(
                self.input("medical_claim"), self.input("practitioner"), stamped=False
            )
        return enrich.encounter_enrichment(
            self.table("fact_encounters"),
            providers,
            self.input("diagnosis_categories"),
        )

    def _member_month_risk(self) -> DataFrame:
        mean_rows = None if self.key_rows is None else enrich.MEAN_ROWS
        return enrich.member_month_risk(
            self.input("member_month"), self.input("risk_scores_monthly"), mean_rows
        )

    def _fact_encounters(self) -> DataFrame:
        return facts.encounters(
            self.input("encounter"),
            self.table("dim_encounter_group"),
            self.table("dim_encounter_type"),
            self.key_rows,
        )

    def _fact_claims(self) -> DataFrame:
        return facts.claims(
            self.input("medical_claim"),
            self.table("dim_service_category"),
            self.table("encounter_enrichment"),
            key_rows=self.key_rows,
        )

    def _fact_encounter_service_bridge(self) -> DataFrame:
        if "fact_claims" in self.stored:
            links = self.stored["fact_claims"]
        else:
            links = facts.encounter_service_links(
                self.input("medical_claim"),
                self.table("dim_service_category"),
                self.table("fact_encounters"),
                key_rows=self.key_rows,
            )
        return facts.encounter_service_bridge(links, self.run_ts)

    def _fact_admissions(self) -> DataFrame:
        return facts.admissions(
            self.input("augmented_admissions"),
            self.input("encounter"),
            self.input("readmissions"),
            self.input("pqi_summary"),
        )

    def _fact_ed_visits(self) -> DataFrame:
        return facts.ed_visits(self.input("encounter"), self.input("ed_classification"))

    def _fact_hcc_gaps(self) -> DataFrame:
        return facts.hcc_gaps(self.input("hcc_suspects"))

    def _fact_member_months(self) -> DataFrame:
        return facts.member_months(
            self.input("member_month"),
            self.input("risk_scores_monthly"),
            self.input("cost"),
            self.table("member_month_risk"),
        )

    def _fact_pharmacy_claims(self) -> DataFrame:
        return facts.pharmacy_claims(
            self.input("pharmacy_claim"),
            self.input("drug_packages"),
            self.input("drugs"),
            self.input("drug_classes"),
            self.input("practitioner"),
            self.specialty_threshold,
        )

    def _fact_quality_measures(self) -> DataFrame:
        return facts.quality_measures(self.input("quality_measures"))

    def _fact_risk_factors(self) -> DataFrame:
        return facts.risk_factors(self.input("risk_factors"))

    def _fact_risk_scores(self) -> DataFrame:
        return facts.risk_scores(self.input("risk_scores"))


class RulesViolated(Exception):
    """A built table breaks rules; ``violations`` maps (check, table, columns) to their number."""

    def __init__(self, violations: dict[tuple[str, str, str], int]):
        super().__init__(", ".join(f"{' '.join(k)}: {n}" for k, n in violations.items()))
        self.violations = violations


def _stop_on(broken: dict[tuple[str, str, str], int]) -> None:
    if any(broken.values()):
        raise RulesViolated({key: n for key, n in broken.items() if n})


def _stop_on_violations(star: Star, rules: Sequence[quality.Rule]) -> None:
    if rules:
        counted = quality.run(star.resolve, rules).filter("violations > 0").collect()  # a row a rule
        _stop_on({(r.check_name, r.table_name, r.column_names): r.violations for r in counted})


def _observed(frame: DataFrame, rules: Sequence[quality.Rule]) -> tuple[DataFrame, Callable[[], dict]]:
    """The frame, and the nulls that its writing will have seen by not_null rule.

    A task that runs again after its executor was lost may count its nulls twice; none stays none.
    """
    metrics = quality.null_metrics(rules)
    if not metrics:
        return frame, dict
    observation = Observation()
    named = [column.alias(f"n{at}") for at, column in enumerate(metrics.values())]
    observed = frame.observe(observation, *named)

    def counts() -> dict[tuple[str, str, str], int]:
        seen = observation.get
        return {(r.check, r.table, r.columns[0]): seen[f"n{at}"] for at, r in enumerate(metrics)}

    return observed, counts


def build(
    spark: SparkSession,
    star: Star,
    sink,
    tables: Iterable[str] = TABLES,
    rules: Iterable[quality.Rule] = (),
    coverage: Iterable[str] = (),
) -> dict[str, DataFrame]:
    """Rebuild ``tables`` into ``sink`` and return them as read back from it.

    Each table is written once and later ones start from the stored copy, so lost executors cost
    at most the tasks of the table at hand. The wanted tables are always computed from the inputs:
    ``star`` itself is not changed, so a build, failed or not, can be repeated with it.

    Of ``rules`` (``quality.RULES``, for instance) those of a table are checked with it: nulls are
    counted while it is written, so they cost no scan of
    their own, the others run over the stored copy. Assertions named in ``coverage`` (of
    ``quality.COVERAGE``) run right after the last table they need. What breaks any of them stops the
    build with ``RulesViolated``.
    """
    wanted, coverage = set(tables), list(coverage)
    unknown = wanted - set(TABLES)
    if unknown:
        raise KeyError(f"not a published table: {sorted(unknown)}")
    if not set(coverage) <= set(quality.COVERAGE):
        raise KeyError(f"not a coverage assertion: {sorted(set(coverage) - set(quality.COVERAGE))}")
    kept = {name: frame for name, frame in star.stored.items() if name not in wanted}
    own = Star(star.inputs, star.run_ts, star.specialty_threshold, kept, star.key_rows)
    rules = list(rules)
    for name in TABLES:
        if name in wanted:
            ruled = [r for r in rules if r.table == name]
            frame = own.table(name)
            observed, nulls = _observed(frame, ruled)
            sink.write(name, observed)
            own.stored[name] = sink.read(spark, name, frame)
            own.forget()
            _stop_on(nulls())
            _stop_on_violations(own, [r for r in ruled if r.check != "not_null"])
        for check in coverage:
            last, uncovered = quality.COVERAGE[check]
            if last == name:
                _stop_on({("coverage", name, check): uncovered(own.resolve).count()})
    return {name: own.stored[name] for name in TABLES if name in wanted}
