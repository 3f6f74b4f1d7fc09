"""Readers for the pipeline's inputs."""
