"""Document-text analytics for right-to-left and mixed-script collections, on Spark DataFrames."""
