"""Registered queries, grouped by theme."""

from importlib import import_module

THEMES = ("shaping", "linking", "merging", "coding", "auditing", "resolution", "rebuild", "publishing", "versions", "job")


def all_entries():
    from ledgerloom.catalog.registry import ENTRIES

    for theme in THEMES:
        import_module(f"ledgerloom.catalog.{theme}")
    return dict(ENTRIES)
