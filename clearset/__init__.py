"""Find and remove bad rows in large labelled training sets, on Spark."""
