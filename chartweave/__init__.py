"""Clinical-record analytics as Spark DataFrame plans."""
