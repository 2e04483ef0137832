"""turnloom: curation of conversational training data on Spark DataFrames."""
