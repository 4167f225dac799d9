"""Commerce order analytics on Spark: batch tables and event streams, one set of operators."""
