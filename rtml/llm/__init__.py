"""Operators for preparing and inspecting language-model training data."""
