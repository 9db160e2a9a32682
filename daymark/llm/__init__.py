"""Operators for preparing text corpora that models are trained on."""
