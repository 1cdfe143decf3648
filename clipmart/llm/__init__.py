"""Operators for preparing training corpora, their queries (``queries``) and
their DuckDB oracles (``oracles``).  Nothing else in the library imports this
subpackage."""
