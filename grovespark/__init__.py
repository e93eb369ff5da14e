"""grovespark: integrate and compare large rooted hierarchies on Spark."""
