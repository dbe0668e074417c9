from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adlake.llm import queries
from adlake.llm.line_dedup import dedup_lines


def brute(rows):
    """Kept texts in order of doc_id; rows are (doc_id, text), ids distinct."""
    seen, out = set(), {}
    for number, text in sorted(rows):
        lines = text.split("\n")
        gone, own = set(), []
        for at in range(len(lines) - 2):
            window = tuple(line.strip(" \t\r") for line in lines[at : at + 3])
            if any(window):
                if window in seen:
                    gone |= {at, at + 1, at + 2}
                seen.add(window)
        out[number] = ("\n".join(line for at, line in enumerate(lines) if at not in gone), len(gone))
    return out


def test_later_windows_go(make):
    rows = [
        (1, "a\nb\nc\nd"), (2, "x\na \nb\nc\ny"), (3, "b\nc\nd\ne\nf"), (4, "q\nq\nq\nq\nq"), (5, "a\nb"), (6, "\n\n\n\n"), (7, "\n\n\n\nz"),
        (8, "a\nb\nc\nd"), (9, "c\nd"),
    ]
    found = {row["doc_id"]: (row["text"], row["n_removed"]) for row in dedup_lines(make(rows)).collect()}
    assert found == brute(rows)


def test_odd_rows(odd, empty):
    rows = dedup_lines(odd.withColumn("n_lines", F.lit("clash"))).collect()
    assert len(rows) == odd.count()
    assert sorted((row["n_lines"], row["n_removed"]) for row in rows if row["text"] is None) == [(0, 0), (0, 0)]
    # Rows that repeat id and text are one document; the copy under another id goes whole.
    assert [row["n_removed"] == row["n_lines"] for row in rows if row["doc_id"] in (5, 6)] == [False, True, True]
    assert dedup_lines(empty).count() == 0


def test_columns_of_any_name_pass_through(make):
    text = "one\ntwo\nthree\nfour"
    docs = make([(1, text), (2, text)])
    for value in (F.lit(7), F.lit("x"), F.lit(None).cast("long")):
        names = ["_id", "_hash", "_covered", "_row", "at", "lines", "a.b"]
        rows = dedup_lines(docs.withColumns({name: value for name in names})).orderBy("doc_id").collect()
        assert [(row["n_lines"], row["n_removed"], row["text"]) for row in rows] == [(4, 0, text), (4, 4, "")]
        assert all(row[name] == rows[0]["_id"] for row in rows for name in names)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_and_its_twin(spark, sf_dir, name):
    from compare import connect, difference

    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None
