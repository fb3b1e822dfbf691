"""Jobs made of the operators: conform, score, load and serve."""
