"""Reading: databases over JDBC, Parquet lakes, catalogs and object listings."""
