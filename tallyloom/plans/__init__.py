"""Reports: each takes input frames and parameters and returns one frame."""
