"""The named queries of this package and their SQL twins."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "mixing",
    "quality",
    "substring",
    "chat",
    "tokens",
    "lm",
    "near",
    "line_dedup",
    "sharding",
    "decontaminate",
    "binary",
    "audit",
    "fim",
)
_parts = [import_module(f"actionspark.llm.{m}") for m in MODULES]
QUERIES = {name: f for part in _parts for name, f in part.QUERIES.items()}
SQL = {name: text for part in _parts for name, text in part.SQL.items()}
