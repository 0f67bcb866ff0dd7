"""Commerce analytics as DataFrame-to-DataFrame functions on PySpark."""
