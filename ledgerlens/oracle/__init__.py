"""DuckDB SQL text for every query that plain SQL can express."""
