"""Document-structuring engine built on Spark DataFrames."""
