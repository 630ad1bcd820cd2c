"""The register without the corpus queries, or without a library that they need."""

import builtins
import importlib
import sys

import pytest

import __spark_entry__ as registered
from feedlake.plans.queries import QUERIES


@pytest.mark.parametrize("absent, warns", [("xxhash", True), ("feedlake.llm", False), ("corpus_pipeline", False)])
def test_other_queries_stay_registered(monkeypatch, absent, warns):
    real = builtins.__import__

    def refuse(name, module_globals=None, module_locals=None, fromlist=(), level=0):
        if name == absent or name.startswith(f"{absent}."):
            raise ModuleNotFoundError(f"No module named {absent!r}", name=absent)
        return real(name, module_globals, module_locals, fromlist, level)

    for name in list(sys.modules):
        if name == "corpus_pipeline" or name.startswith("feedlake.llm"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", refuse)
    try:
        with pytest.warns(UserWarning, match=absent) if warns else monkeypatch.context():
            importlib.reload(registered)
        assert registered.queries().keys() == QUERIES.keys() and registered.oracle_sql().keys() == QUERIES.keys()
    finally:
        monkeypatch.undo()
        importlib.reload(registered)
