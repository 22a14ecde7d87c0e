"""msgflow: message-stream operators on Spark DataFrames."""
