"""All registered queries of the library, with their SQL."""

from __future__ import annotations

from lexspark.plans import catalogue
from lexspark.plans import files as _files  # noqa: F401 - registers its queries

queries, oracle_sql = catalogue.queries, catalogue.oracle_sql
