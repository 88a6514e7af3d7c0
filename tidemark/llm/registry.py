"""All queries and SQL texts of this subpackage."""

from __future__ import annotations

from importlib import import_module

MODULES = ("sharding", "mixing", "neardup", "language", "licenses", "chat", "topk", "toxicity", "repeats", "decontam", "hardneg",
           "mixing_lm", "alignment")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = import_module(f"tidemark.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLE |= _module.ORACLE
