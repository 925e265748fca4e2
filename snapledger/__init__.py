"""Work-item snapshot reporting on Spark DataFrames."""
