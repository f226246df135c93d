"""Intentionally empty: the feature set this engine covers is batch only.

There is no event-time window, watermark or stateful operator to express, so
nothing is offered here rather than inventing behaviour.
"""
