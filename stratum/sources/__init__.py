"""Sources and sinks: Parquet/JSON/CSV files, JDBC sources, catalog tables and load modes."""
