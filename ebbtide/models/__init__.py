"""Spark ML pipelines: preparation, candidates, tuning, calibration, segmentation."""
