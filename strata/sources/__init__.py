"""Readers and landed inputs."""
