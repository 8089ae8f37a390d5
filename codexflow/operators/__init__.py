"""Relational operators: search, versions, links, diffs, segments, layout and what is published."""
