"""queries(): a broken import must not take queries away silently."""

import sys

import pytest

import __spark_entry__ as entry


def test_a_missing_dependency_is_an_error(monkeypatch):
    monkeypatch.setitem(sys.modules, "pixloom.llm.queries", None)
    with pytest.raises(ImportError):
        entry.queries()


def test_all_found_queries():
    assert {f"p{n}_found" for n in (2, 3, 4, 5, 9)} <= entry.queries().keys()
