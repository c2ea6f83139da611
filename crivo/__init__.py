"""Cross-sectional screening, history and model evaluation on Spark DataFrames."""
