"""Registered queries, one per operator, with equivalent SQL where it can be written.

Each module has a ``QUERIES`` dict: name -> (function of session and folder, SQL or None).
"""

from __future__ import annotations

from gristmill.queries import corpus, dedup, evaluation, fuzzy, io, models, pii, text

ALL = {}
for _module in (io, pii, text, models, dedup, fuzzy, evaluation, corpus):
    for _name, _entry in _module.QUERIES.items():
        if _name in ALL:
            raise ValueError(f"query registered twice: {_name}")
        ALL[_name] = _entry
