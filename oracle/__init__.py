"""DuckDB SQL for the registered queries, written apart from the Spark code it checks."""
