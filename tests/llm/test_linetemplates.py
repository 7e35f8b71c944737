import duckdb
import pytest
from helpers import documents, edge_texts, edges, empty, prose

from docsift.llm import linetemplates as L


def by_sql(rows, least):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return sorted(con.execute("SELECT doc_id, kept, n_lines, n_dropped FROM (" + L.kept_sql(min_texts=least) + ")")
                  .fetchall(), key=str)


def run(docs, least):
    out = L.drop_recurring(docs, least, counts=True)
    return sorted(map(tuple, out.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


def boilerplate():
    rows = []
    for i in range(30):
        lines = [prose(i * 10 + k, 12) for k in range(3)]
        if i % 2 == 0:
            lines.insert(1, "All rights reserved by the house")
        if i % 3 == 0:
            lines.append(f"Page {i} of {i + 9} printed on day {i * 31} for you")
        if i % 5 == 0:
            lines.append(f"Send your letters to the office of {['north', 'south', 'east'][i % 3]} street please today now")
        rows.append((i, "\n".join(lines)))
    return rows + [(40 + i, rows[7][1]) for i in range(20)]  # one text, many copies


@pytest.mark.parametrize("least", [3, 10])
def test_against_sql(spark, least):
    for rows in (boilerplate(), edge_texts()):
        assert run(documents(spark, rows).repartition(4), least) == by_sql(rows, least)


def test_templates_stay_once_and_clean_lines_stay(spark):
    rows = boilerplate()
    texts = {r[0]: r[1] for r in run(documents(spark, rows), 5)}
    assert sum("All rights reserved" in t for t in texts.values()) == 1
    assert sum("printed on day" in t for t in texts.values()) == 1
    for i, text in rows:
        for line in text.split("\n"):
            if not line.startswith(("All", "Page", "Send")):
                assert line in texts[i].split("\n")


def shared(size):
    """A line with three fields of common values in every document, next to prose."""
    return [(i, prose(i, 14) + f"\nShared by the name{'abcdefghijklmnopqrst'[i % 20]} desk in city{'abcdefghijklm'[i * 7 % 13]} on our "
             f"section{'abcdefg'[i * 5 % 7]} page today for you\n" + prose(i + size, 14)) for i in range(size)]


@pytest.mark.parametrize("size", [200, 1000, 4000])
def test_fields_of_common_values(spark, size):
    rows = shared(size)
    out = run(documents(spark, rows).repartition(4), 10)
    assert out == by_sql(rows, 10)
    assert sum("Shared by the" in r[1] for r in out) == 1
    clean = {i: t.split("\n") for i, t in rows}
    assert all(r[1].split("\n")[0] == clean[r[0]][0] and r[1].split("\n")[-1] == clean[r[0]][2] for r in out)


def test_edges(spark):
    docs = edges(spark)
    out = L.drop_recurring(docs, 2)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert L.drop_recurring(empty(spark)).collect() == []


def test_no_python(spark):
    plan = L.drop_recurring(edges(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
