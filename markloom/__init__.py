"""Wiki-markup corpora as Spark jobs: clean, convert, count, compare."""
