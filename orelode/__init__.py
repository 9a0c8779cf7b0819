"""A sales lakehouse on Spark: raw, clean and star-schema layers, checks and questions."""
