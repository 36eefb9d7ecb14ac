import importlib
import sys


def test_queries_without_the_training_data_operators(monkeypatch):
    import __spark_entry__ as entry

    assert {"redaction_summary", "slot_agreement", "record_scores"} <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for name in [m for m in sys.modules if m.startswith("gleanery.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)

    class Missing:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("gleanery.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Missing(), *sys.meta_path])
    monkeypatch.delattr(importlib.import_module("gleanery"), "llm", raising=False)
    importlib.reload(entry)
    assert not any(n.startswith("op") or n == "pipeline" for n in entry.queries())
    monkeypatch.undo()
    importlib.reload(entry)


def test_every_oracle_has_a_query():
    from gleanery.plans import catalogue

    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)
