"""Where data comes from and goes to: landing files and the load plan, table
sinks (Parquet paths, catalog tables, CSV, JDBC), and the adapter that turns
the supplied test tables into landing-shaped trips and zones."""
