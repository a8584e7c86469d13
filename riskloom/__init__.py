"""riskloom: payment-risk data engineering and analytics on Spark DataFrames."""
