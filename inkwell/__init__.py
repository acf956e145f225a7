"""inkwell: quality control of long-form text corpora as Spark DataFrame operators."""
