"""Transforms: DataFrame in, DataFrame out, batch or stream."""
