"""Training-data operators: one module per operator, queries in ``queries.py``, DuckDB SQL in ``oracles.py``."""
