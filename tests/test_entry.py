import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 25


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "retention_d1" in df.columns


def test_entry_works_without_the_optional_parts(monkeypatch):
    import importlib.abc
    import importlib.util

    class Missing(importlib.abc.MetaPathFinder):
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("playmetrics.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for name in list(sys.modules):
        if name == "corpus_pipeline" or name.startswith("playmetrics.llm"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Missing(), *sys.meta_path])
    spec = importlib.util.spec_from_file_location("bare_entry", E.__file__)
    bare = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(bare)
    assert "pipeline" not in bare.queries() and len(bare.queries()) >= 30
    assert set(bare.oracle_sql()) == set(bare.queries())
