"""Logical plans of the lake: pure transforms, marts, quality checks and the jobs that run them."""
