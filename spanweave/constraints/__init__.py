"""The constraint language: expressions as JSON trees, a builder for them, and their evaluation over DataFrames."""
