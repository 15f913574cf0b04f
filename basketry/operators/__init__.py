"""Analyses as pure DataFrame transforms (batch and streaming alike)."""
