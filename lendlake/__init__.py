"""Credit-portfolio risk analytics as Spark DataFrame and MLlib operators."""
