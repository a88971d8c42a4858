"""Field-sensing geodata on Spark DataFrames."""
