"""Adjacent notices, null ids against the SQL, and rows that share an id among the neighbours."""

import sys
from pathlib import Path

import duckdb
import pyarrow as pa
from compare import differences

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.llm import licenses, lines, neighbours


def test_weaker_notices_before_better_ones_are_found():
    spans = lambda text: [s[:4] for s in licenses.scan(text.encode())["spans"]]
    assert spans("all rihgts reserved x all rights reserved") == [("reserved", 0, 2, 2), ("reserved", 4, 6, 0)]
    assert spans("all rihgts reserved all rights reserved all rigts reserved") == [("reserved", 0, 2, 2), ("reserved", 3, 5, 0), ("reserved", 6, 8, 1)]
    assert spans("all rights reserved " * 50) == [("reserved", 3 * i, 3 * i + 2, 0) for i in range(50)]
    assert spans("no notice at all") == []


def test_lines_of_null_ids_against_sql(spark):
    passage = "first line\nsecond line\nthird line"
    rows = [(5, f"a\n{passage}"), (None, f"b\n{passage}\nc\n{passage}"), (None, "no window"), (7, None), (None, None), (7, f"{passage}\n{passage}")]
    connection = duckdb.connect()
    ids, texts = zip(*rows, strict=True)
    connection.register("documents", pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())}))
    found = lines.remove_repeated_windows(spark.createDataFrame(rows, "doc_id bigint, text string"), counts=("n_lines", "n_removed"))
    assert differences(found, connection, lines.ORACLE) is None


def test_neighbours_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0]), (1, [5.0, 0.0]), (1, [9.0, 0.0]), (1, [9.0, 0.0]), (2, [3.0, 0.5]), (20, [1.0, 1.0]), (20, [2.0, 0.0])]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id % 20 = 0", top=3)
    lists = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())
    assert [x[1:] for x in lists if x[0] == 0] == [(1, 1, 9.0), (2, 1, 5.0), (3, 2, 3.0)]
    assert [x[1:] for x in lists if x[0] == 20] == [(1, 1, 9.0), (1, 1, 18.0), (2, 1, 5.0), (2, 1, 10.0), (3, 2, 3.5), (3, 2, 6.0)]
