"""Jobs on tables: DataFrame in, DataFrame out."""
