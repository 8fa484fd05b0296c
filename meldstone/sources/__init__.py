"""Inputs, outputs and shared storage."""
