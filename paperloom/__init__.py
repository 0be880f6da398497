"""paperloom: bibliometric and text-corpus analytics as composable Spark DataFrames."""
