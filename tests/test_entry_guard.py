"""The entry module works without the operators for training data."""

import importlib
import sys

from cardrail.plans import catalog


def test_entry_without_the_optional_modules(monkeypatch):
    import __spark_entry__

    monkeypatch.setitem(sys.modules, "cardrail.llm.queries", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        bare = importlib.reload(__spark_entry__)
        assert bare.llm is None and bare.corpus_pipeline is None
        assert set(bare.queries()) == set(catalog.QUERIES) and set(bare.oracle_sql()) <= set(bare.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
