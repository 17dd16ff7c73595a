"""The registered queries over the given test tables, and the same questions as DuckDB SQL."""
