"""DuckDB SQL that states the expected result of each query, for the correctness check."""
