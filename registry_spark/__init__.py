"""Unify national facility registries and their service lists with Spark DataFrames."""
