"""Product-catalogue analytics on Spark: profile, clean, score, rank, and compare feature sets."""
