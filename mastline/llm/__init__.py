"""Operators of a training-data pipeline: language, copies, toxicity, licences, tokens, mixing, leaks and secrets."""
