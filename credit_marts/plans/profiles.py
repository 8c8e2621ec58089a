"""Which operators profile which credit table.

``PROFILES`` states, per table, its key, references, columns and measures; ``profile_queries``
turns that into one DataFrame per question and ``run_all`` into one long table of metrics.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_marts.functions import age_years
from credit_marts.operators import profile as p
from credit_marts.operators.checks import Link

# Fixed value: stands for "no value" in a DAYS column.
DAYS_SENTINEL = 365243

APPLICATIONS = ("application_train", "application_test")
BOUNDS = ("min", "max")


@dataclass(frozen=True)
class TableProfile:
    """What is asked of one table."""

    keys: tuple[str, ...] = ()
    references: tuple[tuple[str, tuple[str, ...]], ...] = ()
    target: str | None = None
    nullable: tuple[str, ...] = ()
    measures: tuple[p.Measure, ...] = ()
    categories: tuple[str, ...] = ()
    status: str | None = None
    missing_event: tuple[str, str] | None = None
    delay: tuple[str, str, str] | None = None


def _column(name: str, stats: Sequence[str] = p.Measure.stats, **kw) -> p.Measure:
    return p.Measure(name.lower(), name, tuple(stats), **kw)


def _application(target: str | None) -> TableProfile:
    # Columns of interest of an application.
    return TableProfile(
        keys=("SK_ID_CURR",),
        target=target,
        nullable=(
            "EXT_SOURCE_1",
            "EXT_SOURCE_2",
            "EXT_SOURCE_3",
            "OCCUPATION_TYPE",
            "AMT_ANNUITY",
            "AMT_GOODS_PRICE",
            "NAME_TYPE_SUITE",
        ),
        measures=(
            p.Measure("age_years", age_years(F.col("DAYS_BIRTH"))),
            _column("DAYS_EMPLOYED", BOUNDS, sentinel=DAYS_SENTINEL),
            p.Measure("income", "AMT_INCOME_TOTAL"),
            p.Measure("credit", "AMT_CREDIT"),
            _column("CNT_CHILDREN", BOUNDS),
        ),
        categories=(
            "CODE_GENDER",
            "NAME_CONTRACT_TYPE",
            "NAME_INCOME_TYPE",
            "NAME_EDUCATION_TYPE",
            "NAME_FAMILY_STATUS",
            "NAME_HOUSING_TYPE",
        ),
    )


def profiles() -> dict[str, TableProfile]:
    """Profiles of the eight tables. Needs an active Spark session, as columns do."""
    to_previous = ("SK_ID_PREV", ("previous_application",))
    to_application = ("SK_ID_CURR", APPLICATIONS)
    # Keys, references and columns of interest of each table.
    return {
        "application_train": _application("TARGET"),
        "application_test": _application(None),
        "bureau": TableProfile(
            keys=("SK_ID_BUREAU",),
            references=(to_application,),
            nullable=("AMT_CREDIT_SUM_DEBT", "DAYS_CREDIT_ENDDATE", "AMT_CREDIT_MAX_OVERDUE", "AMT_ANNUITY"),
            measures=(
                _column("DAYS_CREDIT"),
                _column("CREDIT_DAY_OVERDUE", BOUNDS),
                _column("AMT_CREDIT_SUM"),
            ),
            categories=("CREDIT_ACTIVE", "CREDIT_TYPE", "CREDIT_CURRENCY"),
        ),
        "bureau_balance": TableProfile(
            keys=("SK_ID_BUREAU", "MONTHS_BALANCE"),
            references=(("SK_ID_BUREAU", ("bureau",)),),
            measures=(_column("MONTHS_BALANCE"),),
            status="STATUS",
        ),
        "previous_application": TableProfile(
            keys=("SK_ID_PREV",),
            references=(to_application,),
            nullable=(
                "RATE_INTEREST_PRIMARY",
                "RATE_INTEREST_PRIVILEGED",
                "AMT_DOWN_PAYMENT",
                "AMT_ANNUITY",
                "CNT_PAYMENT",
            ),
            measures=(
                _column("AMT_APPLICATION", BOUNDS),
                _column("AMT_CREDIT", BOUNDS),
                _column("DAYS_DECISION", BOUNDS),
                _column("DAYS_FIRST_DRAWING", BOUNDS, sentinel=DAYS_SENTINEL),
            ),
            categories=("NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE", "CODE_REJECT_REASON"),
        ),
        "credit_card_balance": TableProfile(
            keys=("SK_ID_PREV", "MONTHS_BALANCE"),
            references=(to_previous, to_application),
            nullable=(
                "AMT_DRAWINGS_ATM_CURRENT",
                "AMT_DRAWINGS_OTHER_CURRENT",
                "AMT_DRAWINGS_POS_CURRENT",
                "AMT_PAYMENT_CURRENT",
            ),
            measures=(_column("AMT_BALANCE"), _column("SK_DPD", BOUNDS)),
            status="NAME_CONTRACT_STATUS",
        ),
        "POS_CASH_balance": TableProfile(
            keys=("SK_ID_PREV", "MONTHS_BALANCE"),
            references=(to_previous, to_application),
            nullable=("CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"),
            measures=(
                _column("SK_DPD"),
                _column("SK_DPD_DEF", BOUNDS),
                _column("MONTHS_BALANCE", BOUNDS),
            ),
            status="NAME_CONTRACT_STATUS",
        ),
        # No uniqueness question: one installment may be paid in several payments.
        "installments_payments": TableProfile(
            references=(to_previous, to_application),
            missing_event=("AMT_PAYMENT", "DAYS_ENTRY_PAYMENT"),
            delay=("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "NUM_INSTALMENT_NUMBER"),
        ),
    }


# Every reference from a child table to its parents.
LINKS = (
    Link("bureau", "SK_ID_CURR", APPLICATIONS),
    Link("bureau_balance", "SK_ID_BUREAU", ("bureau",)),
    Link("previous_application", "SK_ID_CURR", APPLICATIONS),
    Link("credit_card_balance", "SK_ID_PREV", ("previous_application",)),
    Link("credit_card_balance", "SK_ID_CURR", APPLICATIONS),
    Link("POS_CASH_balance", "SK_ID_PREV", ("previous_application",)),
    Link("POS_CASH_balance", "SK_ID_CURR", APPLICATIONS),
    Link("installments_payments", "SK_ID_PREV", ("previous_application",)),
    Link("installments_payments", "SK_ID_CURR", APPLICATIONS),
)


Question = Callable[[Mapping[str, DataFrame]], DataFrame]


def table_questions(name: str, profile: TableProfile) -> dict[str, Question]:
    """The questions asked of one table, by short name; each builds its answer from the tables."""
    asked: dict[str, Question] = {}
    if profile.keys:
        asked["keys"] = lambda tables: p.key_profile(tables[name], profile.keys)
    else:
        asked["rows"] = lambda tables: p.row_count(tables[name])
    for key, parents in profile.references:
        asked[f"orphan_{key.lower()}"] = lambda tables, key=key, parents=parents: p.orphan_count(
            tables[name], key, [p.Parent(tables[parent], key) for parent in parents]
        )
    if profile.target:
        asked["class_balance"] = lambda tables: p.class_balance(tables[name], profile.target)
    if profile.nullable:
        asked["null_rates"] = lambda tables: p.null_rates(tables[name], profile.nullable)
    if profile.measures:
        asked["ranges"] = lambda tables: p.range_stats(tables[name], profile.measures)
    if profile.categories:
        asked["categories"] = lambda tables: p.category_counts(tables[name], profile.categories)
    if profile.status:
        asked["statuses"] = lambda tables: p.value_counts(tables[name], profile.status)
    if profile.missing_event:
        asked["missing"] = lambda tables: p.missing_event_profile(tables[name], *profile.missing_event)
    if profile.delay:
        asked["delays"] = lambda tables: p.delay_profile(tables[name], *profile.delay)
    return asked


def profile_query(tables: Mapping[str, DataFrame], table: str, question: str) -> DataFrame:
    """The answer to one question about one table, lazily."""
    return table_questions(table, profiles()[table])[question](tables)


def profile_queries(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All questions of all tables, as lazy DataFrames named ``<table>_<question>``."""
    return {
        f"{name}_{question}": answer(tables)
        for name, profile in profiles().items()
        for question, answer in table_questions(name, profile).items()
    }


def run_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every single-valued metric of every table as (table_name, metric, value).

    NULL rates, ranges, missing events and delays of a table share one scan; keys and references
    add one each.
    """
    parts: list[DataFrame] = []
    for name, profile in profiles().items():
        missing = dict(zip(("amount", "day"), profile.missing_event)) if profile.missing_event else None
        metrics = [p.profile_table(tables[name], profile.nullable, profile.measures, missing, profile.delay)]
        for question, answer in table_questions(name, profile).items():
            if question == "keys" or question.startswith("orphan_"):
                metrics.append(p.long_form(answer(tables).drop("row_count")))
        parts += [m.select(F.lit(name).alias("table_name"), "metric", "value") for m in metrics]
    return reduce(DataFrame.unionAll, parts)
