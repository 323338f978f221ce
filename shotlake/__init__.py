"""Keyframe analytics on Spark: videos, shots, frames, candidates and vectors as DataFrames."""
