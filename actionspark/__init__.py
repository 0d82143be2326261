"""Customer action analytics on Spark: features, scoring and monitoring as DataFrame functions."""
