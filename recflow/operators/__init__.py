"""DataFrame -> DataFrame operators of the recommendation pipeline."""
