"""Composite flows: normalisation presets, star build, reports."""
