"""Star-catalogue tables on PySpark: sources, sky functions, matching, tables."""
