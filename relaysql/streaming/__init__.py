"""Structured Streaming runner for jobs."""
