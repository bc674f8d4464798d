"""statkit: Spark building blocks for public-statistics data."""
