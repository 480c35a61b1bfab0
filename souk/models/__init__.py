"""Spark ML models: segmentation, churn, review score, and their evaluation."""
