"""Customer data warehouse jobs as plain DataFrame functions on PySpark."""
