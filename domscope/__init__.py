"""Entity resolution and review over web-domain intelligence, on Spark DataFrames."""
