"""fragstream: versioned event streams published as linked, range-annotated fragments, replicated and queried with Spark DataFrames."""
