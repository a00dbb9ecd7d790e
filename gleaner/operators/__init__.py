from gleaner.operators import aggregate, dedup, extract, joins, ledger, numbering, skew  # noqa: F401
