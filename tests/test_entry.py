import importlib

import pytest


def test_entry_and_registry(spark):
    e = importlib.import_module("__spark_entry__")
    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_llm_is_apart():
    """Nothing outside the subpackage imports it."""
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    for p in (root / "harrow").rglob("*.py"):
        if "llm" not in p.relative_to(root / "harrow").parts:
            assert "harrow.llm" not in p.read_text(), p


def test_entry_without_llm(monkeypatch):
    import importlib.util

    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n.startswith("harrow.llm") or n == "corpus_pipeline" else find(n, *a))
    e = importlib.reload(importlib.import_module("__spark_entry__"))
    try:
        assert e.queries() and not any(n.startswith("op") for n in e.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(e)


@pytest.mark.parametrize("folder", ["operators", "sources", "functions", "plans", "streaming"])
def test_packages_import(folder):
    assert importlib.import_module(f"harrow.{folder}")
