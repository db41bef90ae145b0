"""Diffusion and text analytics over message channels, on Spark DataFrames."""
