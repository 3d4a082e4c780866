"""Model training, scoring, evaluation and explanation."""
