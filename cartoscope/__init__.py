"""Spark operators for spatial annotations, detections, landmarks, transforms and corpus tables."""
