"""Reading and writing tables: files, JDBC, dated history, reports, SQL workspace."""
