"""All registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "toxicity", "packing", "embedding_join", "ngram_join", "passages", "licenses", "phrase_index", "quality", "line_runs", "secrets",
    "vector_codes", "conversations", "bpe",
)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in import_module(f"farelens.llm.{m}").QUERIES.items()}


def statements() -> dict[str, str]:
    return {name: q for m in MODULES for name, q in import_module(f"farelens.llm.{m}").SQL.items()}
