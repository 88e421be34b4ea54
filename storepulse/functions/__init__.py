"""Column functions; all of them compile to built-in Spark expressions."""
