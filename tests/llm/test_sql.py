"""The native operators against DuckDB, and every operator on odd and empty tables."""

import pytest
from compare import differences

from llm_help import by_id
from murmur.llm.oracle import SQL
from murmur.llm.queries import QUERIES


OF_DOCUMENTS = [n for n in QUERIES if int(n[2:].split("_")[0]) <= 10]


@pytest.mark.parametrize("name", [n for n in SQL if n in OF_DOCUMENTS])
def test_same_rows_as_sql(spark, corpus, name):
    from llm_help import connect
    problem, n = differences(QUERIES[name](spark, corpus), connect(corpus), SQL[name])
    assert not problem and n > 100


@pytest.mark.parametrize("name", SQL)
def test_same_rows_as_sql_on_given_tables(spark, name):
    import compare
    folder = "/root/testdata/sf0.001"
    problem, n = differences(QUERIES[name](spark, folder), compare.connect(folder), SQL[name])
    assert not problem and n >= (200 if name in OF_DOCUMENTS else 10)


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_empty_tables(spark, blank, name):
    assert QUERIES[name](spark, blank).collect() == []


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_rows_without_id_and_repeated_rows(answer, odd, name):
    found = answer(name, odd)
    assert len(found) == 9
    assert sorted(r["doc_id"] for r in found if r["doc_id"] is not None) == [-4, 1, 1, 1, 2, 2, 3]


def test_lines_of_odd_rows(answer, odd):
    found = by_id(answer("op7_line_bitmaps", odd))
    assert [r["n_dropped"] for r in found[None]] == [0, 0]  # no id: neither counts nor loses
    assert [r["n_dropped"] for r in found[-4]] == [0]
    assert [r["n_dropped"] for r in found[1]] == [1, 1, 1]  # each text under its own bitmap
    assert [r["n_dropped"] for r in found[2]] == [1, 1]
    assert sorted(r["n_lines"] for r in found[1]) == [2, 2, 3]


def test_leaks_of_odd_rows(answer, odd):
    found = by_id(answer("op10_decontamination", odd))
    assert [(r["n_hit"], r["n_items"]) for r in found[2]] == [(1, 1), (1, 1)]
    assert sorted((r["n_hit"], r["n_items"], r["contaminated"]) for r in found[1]) == [(0, 0, False), (1, 0, True), (1, 0, True)]
