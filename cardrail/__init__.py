"""Card-payment record processing as Spark DataFrame functions."""
