"""Readers, writers and the derived test inputs."""
