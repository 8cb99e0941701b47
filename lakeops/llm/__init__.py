"""Operators of a training-data pipeline: language, mixing, secrets, search, packing, counting and three kinds of de-duplication."""
