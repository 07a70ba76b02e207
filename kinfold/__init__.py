"""kinfold: entity resolution and training-data preparation on Spark DataFrames."""
