"""Care-facility quality and staffing analytics on Spark DataFrames."""
