"""Panel analytics on Spark: imputation, window features, mining and ML jobs over entity-by-time panels."""
