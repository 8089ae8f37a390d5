"""All registered queries."""

from __future__ import annotations

from codexflow.plans import assembly, corpora, functions, linking, listings, outputs, pages, publishing, searching, sources, streams, versions, views, wording  # noqa: F401  (they register)
from codexflow.plans.base import ORACLE_SQL, QUERIES  # noqa: F401
