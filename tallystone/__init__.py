"""tallystone: a Spark-first engine for governed financial facts and training-data preparation."""
