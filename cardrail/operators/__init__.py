"""Stages: each takes a DataFrame and returns a DataFrame, in batch and in streaming alike."""
