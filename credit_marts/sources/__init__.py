"""Where data comes from and goes to: landing files, CSV, JDBC, catalog tables."""

from credit_marts.sources.csv_files import csv_to_table, infer_types, named_types, read_csv
from credit_marts.sources.footers import footer_table
from credit_marts.sources.jdbc import jdbc_options, land_all, read_jdbc, write_jdbc
from credit_marts.sources.landing import land, read_landing
from credit_marts.sources.ledger import RunLedger, files_fingerprint, fingerprint
from credit_marts.sources.spec import TABLES, TableSpec, azure_root, table_specs
from credit_marts.sources.tables import ensure_schemas, read_table, recover, shuffles_freed, work_dir, write_table

__all__ = [
    "RunLedger",
    "TABLES",
    "TableSpec",
    "azure_root",
    "csv_to_table",
    "ensure_schemas",
    "files_fingerprint",
    "footer_table",
    "fingerprint",
    "infer_types",
    "jdbc_options",
    "land",
    "land_all",
    "named_types",
    "read_csv",
    "read_jdbc",
    "read_landing",
    "read_table",
    "recover",
    "shuffles_freed",
    "table_specs",
    "work_dir",
    "write_jdbc",
    "write_table",
]
