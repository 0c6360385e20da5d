"""Query plans over the test tables: the catalogue used by ``__spark_entry__``
and the equivalent DuckDB SQL used as an independent oracle."""
