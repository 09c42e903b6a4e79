"""Models and operators: DataFrame in, DataFrame out."""
