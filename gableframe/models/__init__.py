"""Learners: candidate models, tuning, scoring."""
