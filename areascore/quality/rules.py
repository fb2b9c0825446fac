"""Data-quality rules as data, and their evaluation in one pass over a table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areascore.functions.numbers import quotient_of_sums
from areascore.operators.keys import key_counts, outside_of

PASS_MARK = 90


class QualityError(RuntimeError):
    """A gate stopped the run: the rules that failed, and the tables that were not built for it."""

    def __init__(self, message: str, failed: Iterable[tuple] = (), not_built: Iterable[str] = ()):
        super().__init__(message)
        self.failed, self.not_built = tuple(failed), tuple(not_built)


@dataclass(frozen=True)
class Rule:
    """``kind`` is not_null, unique, between, regex, row_count or mean.

    ``where`` limits the rows a rule looks at; ``mostly`` is the share of them that must pass.
    """

    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    pattern: str | None = None
    mostly: float = 1.0
    where: str | None = None


@dataclass(frozen=True)
class Reference:
    """Every key of ``child`` must occur in ``parent``."""

    child: str
    parent: str
    key: str


def _between(column: str, low: float, high: float, mostly: float = 1.0, where: str | None = None) -> Rule:
    return Rule("between", column, low, high, mostly=mostly, where=where)


def _known_between(column: str, low: float, high: float) -> Rule:
    return _between(column, low, high, where=f"{column} IS NOT NULL")


def _key(column: str) -> tuple[Rule, Rule]:
    return Rule("not_null", column), Rule("unique", column)


# The rules attached to each table.
TABLE_RULES: dict[str, tuple[Rule, ...]] = {
    "silver_referentiel_iris": (
        *_key("iris_code"), Rule("not_null", "bv_code"), Rule("not_null", "dep_code"),
    ),
    "silver_filosofi": (*_key("iris_code"), _known_between("taux_pauvrete_60", 0, 100)),
    "silver_rp_population": (*_key("iris_code"), _known_between("population_totale", 0, 100_000)),
    "silver_rp_activite": (*_key("iris_code"), _known_between("taux_chomage_pct", 0, 100)),
    "silver_rp_logement": _key("iris_code"),
    "silver_bpe": (*_key("iris_code"), _between("nb_equipements_total", 0, 5000)),
    "silver_passoires_energetiques": (
        *_key("iris_code"), _known_between("taux_passoires_energetiques_pct", 0, 100),
    ),
    "gold_esg_iris_final": (
        *_key("iris_code"),
        Rule("not_null", "score_esg_0_100"),
        _between("score_esg_0_100", 0, 100),
        _known_between("score_social_0_100", 0, 100),
        _known_between("taux_pauvrete_60", 0, 100),
        _known_between("taux_chomage_pct", 0, 100),
        Rule("not_null", "pct_completude"),
        _between("pct_completude", 0, 100),
        Rule("not_null", "version_modele"),
    ),
    "gold_esg_bassin_vie_final": (*_key("bv_code"), _between("population_totale_bv", 0, 5_000_000)),
}
REFERENCES = (
    Reference("silver_filosofi", "silver_referentiel_iris", "iris_code"),
    Reference("gold_esg_iris_final", "silver_referentiel_iris", "iris_code"),
)
# The acceptance suite of the area master table.
MASTER_SUITE = (
    Rule("not_null", "iris_code"),
    Rule("unique", "iris_code"),
    Rule("row_count", low=500, high=60_000),
    _between("score_esg_0_100", 0, 100),
    _between("pct_completude", 0, 100),
    Rule("mean", "pct_completude", 50, 100),
    _between("taux_pauvrete_60", 0, 100, mostly=0.99),
    _between("taux_chomage_pct", 0, 100, mostly=0.99),
    Rule("not_null", "bv_code"),
    Rule("regex", "iris_code", pattern=r"^\d{9}$"),
)


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _row_counters(rule: Rule) -> tuple[Column, Column]:
    """Per row: is the rule evaluated here, and what counts against it (for a mean: the value)."""
    if rule.kind == "row_count":
        return _flag(F.lit(True)), _flag(F.lit(False))
    value = F.col(rule.column)
    in_scope = F.expr(rule.where) if rule.where else F.lit(True)
    if rule.kind == "not_null":
        return _flag(in_scope), _flag(in_scope & value.isNull())
    known = in_scope & value.isNotNull()
    if rule.kind == "between":
        return _flag(known), _flag(known & ((value < rule.low) | (value > rule.high)))
    if rule.kind == "regex":
        return _flag(known), _flag(known & ~value.rlike(rule.pattern))
    if rule.kind == "mean":
        return _flag(known), F.when(known, value.cast("decimal(20,6)"))
    raise ValueError(f"unknown rule kind {rule.kind}")


def evaluate(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One result row per rule: rows evaluated, rows against it, observed value, verdict.

    All rules share one scan. A unique rule turns the aggregation into two steps, first by its key and
    then overall; counters add up through both, so the table is still read once. Several keys are grouping
    sets of that one scan, and the counters are taken from the first of them.
    """
    rules = tuple(rules)
    keys = list(dict.fromkeys(r.column for r in rules if r.kind == "unique"))
    plain = [i for i, r in enumerate(rules) if r.kind != "unique"]
    counters = {}
    for i in plain:
        counters[f"_e{i}"], counters[f"_v{i}"] = _row_counters(rules[i])
    names = [f"{prefix}{i}" for i in plain for prefix in ("_e", "_v")]
    row_level = df.withColumns(counters | {f"_key{k}": F.col(c) for k, c in enumerate(keys)})
    sums = [F.sum(n).alias(n) for n in names]
    if keys:
        columns = [f"_key{k}" for k in range(len(keys))]
        if len(keys) == 1:
            groups, own = row_level.groupBy(*columns), [F.lit(True)]
        else:
            groups = row_level.groupingSets([[F.col(c)] for c in columns], *(F.col(c) for c in columns))
            sums.append(F.grouping_id().alias("_set"))
            # A set's number has a bit for every key that is not in it, the first key's the highest.
            own = [F.col("_set") == 2 ** len(keys) - 1 - 2 ** (len(keys) - 1 - k) for k in range(len(keys))]
        grouped = groups.agg(F.count(F.lit(1)).alias("_n"), *sums)
        sums = [F.sum(F.when(own[0], F.col(n))).alias(n) for n in names]
        for k, key in enumerate(columns):
            keyed = own[k] & F.col(key).isNotNull()
            sums += [
                F.sum(F.when(keyed, F.col("_n"))).alias(f"_keyed{k}"),
                F.sum(F.when(keyed & (F.col("_n") > 1), F.col("_n"))).alias(f"_repeated{k}"),
            ]
        totals = grouped.agg(*sums)
    else:
        totals = row_level.agg(*sums)
    return totals.select(F.inline(F.array(*(_result(i, r, keys) for i, r in enumerate(rules)))))


def _result(i: int, rule: Rule, keys: list[str]) -> Column:
    names = f"_e{i}", f"_v{i}"
    if rule.kind == "unique":
        k = keys.index(rule.column)
        names = f"_keyed{k}", f"_repeated{k}"
    evaluated = F.coalesce(F.col(names[0]), F.lit(0)).cast("bigint")
    against = F.coalesce(F.col(names[1]), F.lit(0))
    violations = against.cast("bigint")
    if rule.kind == "row_count":
        observed = evaluated.cast("double")
        success = observed.between(rule.low, rule.high)
    elif rule.kind == "mean":
        observed = F.round(quotient_of_sums(against, evaluated), 6).cast("double")
        success = F.coalesce(observed.between(rule.low, rule.high), F.lit(False))
        violations = F.lit(0).cast("bigint")
    else:
        observed = F.lit(None).cast("double")
        success = violations <= evaluated * (1.0 - rule.mostly) + 1e-9
    return F.struct(
        F.lit(i + 1).cast("bigint").alias("rule_no"),
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.column or "").alias("column_name"),
        evaluated.alias("evaluated"),
        violations.alias("violations"),
        observed.alias("observed"),
        success.alias("success"),
    )


def success_percent(results: DataFrame) -> DataFrame:
    share = quotient_of_sums(F.count_if("success") * 100, F.count(F.lit(1)))
    return results.agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if("success").alias("passed"),
        F.round(share, 1).cast("double").alias("success_pct"),
    )


def require_pass(results: DataFrame, mark: int = PASS_MARK) -> float:
    """Raise when fewer than ``mark`` percent of the rules pass."""
    reached = success_percent(results).first()["success_pct"]
    if reached is None or reached < mark:
        raise QualityError(f"only {reached} % of the rules passed, {mark} % are required")
    return reached


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return outside_of(child.where(F.col(key).isNotNull()), parent, key)


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def evaluate_tables(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, tuple[Rule, ...]] = TABLE_RULES,
    kinds: tuple[str, ...] | None = None,
) -> DataFrame:
    """Results of all rules (or those of some kinds) of all given tables."""
    results = []
    for name, df in tables.items():
        chosen = [r for r in rules.get(name, ()) if kinds is None or r.kind in kinds]
        if chosen:
            results.append(evaluate(df, chosen).withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, results)


def evaluate_references(
    tables: Mapping[str, DataFrame], references: Iterable[Reference] = REFERENCES
) -> DataFrame:
    """Number of child rows without a parent, per declared reference.

    All references are tested by one aggregation over the keys of all tables, whatever their number; keys are counted per
    table before the shuffle, so a key that fills a table is no hot spot. Null keys refer to nothing and are
    left out. The keys of a reference have one type.
    """
    chosen = [r for r in references if r.child in tables and r.parent in tables]
    if not chosen:
        raise ValueError("no reference between the given tables")
    sides = list(dict.fromkeys((name, r.key) for r in chosen for name in (r.child, r.parent)))
    counts = key_counts({side: tables[side[0]].select(F.col(side[1]).alias("key")) for side in sides})
    number = {side: f"n{k}" for k, side in enumerate(sides)}
    lost = [
        F.sum(F.when(F.col(number[r.parent, r.key]) == 0, F.col(number[r.child, r.key]))) for r in chosen
    ]
    rows = [
        F.struct(
            F.lit(r.child).alias("table_name"), F.lit(r.parent).alias("parent_name"), F.lit(r.key).alias("column_name"),
            F.coalesce(F.col(f"_lost{k}"), F.lit(0)).cast("bigint").alias("violations"),
        )
        for k, r in enumerate(chosen)
    ]
    totals = counts.agg(*(c.alias(f"_lost{k}") for k, c in enumerate(lost)))
    return totals.select(F.inline(F.array(*rows)))


def broken_rules(df: DataFrame, rules: Iterable[Rule]) -> Column:
    """The rules that a row breaks, as an array of ``kind:column``.

    Rules on whole tables break no row. Every row of a repeated key breaks ``unique``; its key is counted over a window,
    which needs no shuffle where the rows are already dealt by that key.
    """
    labels = []
    for rule in rules:
        if rule.kind in ("not_null", "between", "regex"):
            breaks = _row_counters(rule)[1] == 1
        elif rule.kind == "unique":
            key = F.col(rule.column)
            breaks = key.isNotNull() & (F.count(F.lit(1)).over(Window.partitionBy(rule.column)) > 1)
        else:
            continue
        labels.append(F.when(breaks, F.lit(f"{rule.kind}:{rule.column}")))
    if not labels:
        return F.array().cast("array<string>")
    return F.filter(F.array(*labels), lambda label: label.isNotNull())


def violations_of(df: DataFrame, condition: Column, *columns: str) -> DataFrame:
    """The rows that break a rule, for tests that must come back empty."""
    return df.where(condition).select(*columns)


def out_of_range(df: DataFrame, column: str, low: float, high: float, *columns: str) -> DataFrame:
    value = F.col(column)
    return violations_of(df, value.isNotNull() & ((value < low) | (value > high)), *columns, column)
