"""Table operators: DataFrame in, DataFrame out, no action inside."""
