"""Document operators: DataFrame in, DataFrame out."""
