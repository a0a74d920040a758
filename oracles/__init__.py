"""DuckDB SQL oracles for the registered queries (see ``__spark_entry__.oracle_sql``)."""
