"""Scans, source registry and the binding of the driver's tables to raw inputs."""
