"""Splits, encoders, MLlib pipelines and evaluation."""
