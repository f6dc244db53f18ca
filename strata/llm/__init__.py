"""Training-data operators for language models (nothing else in ``strata`` imports this)."""
