"""Panel metrics as Spark DataFrame operators."""
