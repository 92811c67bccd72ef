"""Named queries over the fixture tables, each paired with the same query in DuckDB SQL."""
