"""Scans: message bus and its file replay, text, sensor logs, lake and live tables."""
