"""Imports that keep their place in a streaming checkpoint."""
