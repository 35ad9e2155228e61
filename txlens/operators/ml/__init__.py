"""MLlib preparation, training, evaluation and curve points."""
