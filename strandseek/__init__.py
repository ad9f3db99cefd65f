"""Local similarity search over sequences of node embeddings, on Spark DataFrames."""
