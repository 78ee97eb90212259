"""Reusable DataFrame operators.

Whole-group values are pre-aggregated and joined back instead of computed in a window, so
no task ever holds a group: the aggregate is combined map-side, and in the join a hot
key's rows may be split over many tasks.
"""
