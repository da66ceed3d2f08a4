"""Whole steps: load a month, build a layer, forecast, evaluate."""
