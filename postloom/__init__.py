"""postloom: Spark-first processing of posting-style records."""
