"""Writers: layered tables and result files."""

from footfall.sinks.files import export_csv, preview
from footfall.sinks.tables import (
    create_databases,
    create_table,
    describe,
    list_tables,
    save,
)

__all__ = [
    "create_databases",
    "create_table",
    "describe",
    "export_csv",
    "list_tables",
    "preview",
    "save",
]
