"""Names and places of the source tables."""

from __future__ import annotations

from dataclasses import dataclass

# Source table names, in the casing of the source.
TABLES = (
    "application_train",
    "application_test",
    "bureau",
    "bureau_balance",
    "previous_application",
    "POS_CASH_balance",
    "installments_payments",
    "credit_card_balance",
)


def azure_root(account: str, container: str = "landing") -> str:
    """Root URI of a container in an ADLS Gen2 account."""
    return f"abfss://{container}@{account}.dfs.core.windows.net"


@dataclass(frozen=True)
class TableSpec:
    """One source table: where it is landed and under which name it is stored.

    ``landing_root`` is any URI or path Spark can read; the table gets a directory below it.
    ``landing_path_override`` replaces the derived path as a whole. ``schema_prefix`` keeps a
    second set of layers apart, for example ``trial_``.
    """

    table: str
    catalog: str = "spark_catalog"
    landing_root: str | None = None
    landing_path_override: str | None = None
    schema_prefix: str = ""

    @property
    def landing_path(self) -> str:
        if self.landing_path_override:
            return self.landing_path_override
        if not self.landing_root:
            raise ValueError(f"{self.table}: neither landing_root nor landing_path_override is set")
        return f"{self.landing_root.rstrip('/')}/{self.table}/"

    @property
    def target_table(self) -> str:
        return self.table_in("bronze")

    def table_in(self, layer: str) -> str:
        """Three-part name of this table in a medallion schema."""
        return f"{self.catalog}.{self.schema_prefix}{layer}.{self.table}"


def table_specs(
    landing_root: str,
    catalog: str = "spark_catalog",
    tables: tuple[str, ...] = TABLES,
    schema_prefix: str = "",
) -> list[TableSpec]:
    """Specs of several tables landed below one root."""
    return [TableSpec(t, catalog, landing_root, schema_prefix=schema_prefix) for t in tables]
