"""The thirty detail tables. Importing the modules fills the registry."""

from . import findings, people, treatment, visits  # noqa: F401
from .registry import DETAILS, build, detail_tables, resource_rows, resource_types, tables_of

__all__ = ["DETAILS", "build", "detail_tables", "resource_rows", "resource_types", "tables_of"]
