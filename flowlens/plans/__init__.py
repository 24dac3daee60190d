"""Fitted preprocessing, training, tuning, run tracking and the batch job."""
