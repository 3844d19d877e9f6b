"""Training-data operators: search, tokenising, mixing, sketches, counts, scoring.

Nothing outside this subpackage imports it. ``quire.llm.queries`` holds the
registered queries and their SQL.
"""
