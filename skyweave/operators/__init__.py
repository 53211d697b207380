"""Relational operators on scenes, boxes, detections and reports."""
