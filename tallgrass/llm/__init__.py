"""Training-data operators: de-duplication, search, tokenizers, archives,
classifiers and source mixing. Nothing outside this package imports it."""
