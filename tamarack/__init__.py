"""Analytics jobs over tables, text and stored pages, written for Spark."""
