"""Composite jobs (``jobs``), test-table fixtures (``fixtures``), the registered queries
(``queries``) and their DuckDB counterparts (``oracle``)."""
