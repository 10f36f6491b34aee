"""Cleaning jobs, star loads, analyses and validations."""
