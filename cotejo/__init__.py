"""Order, invoice and payment reconciliation on Spark DataFrames."""
