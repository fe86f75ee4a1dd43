"""Column expressions: text, paths, times, geometry, keypoints and score calibrations. No Python UDFs."""
