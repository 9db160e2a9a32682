"""The registered corpus queries over the smallest tables, against their SQL where they have some."""

from pathlib import Path

import pytest

from daymark.llm.queries import QUERIES, SQL

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIRECTORY).exists(), reason="test tables are not here")
#: Queries whose rows aren't those of a table: one row in so many gives ten, or as the SQL says.
EACH = {"op13_nearest_neighbours": 100}
DERIVED = {"op11_hard_negatives", "op12_spelling_variants"}
ROWS = {"op2_warc": "pages", "op8_embedding_near_dedup": "embeddings"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(corpus, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIRECTORY}/{table}.parquet'")
    df = QUERIES[name](corpus, DIRECTORY)
    got = df.collect()
    if name == "op1_decontamination":
        # passages are planted as they are
        want = con.execute("SELECT doc_id, item_id FROM documents d, benchmark b WHERE contains(d.text, b.text)").fetchall()
        assert set(want) <= {(r["doc_id"], r["item_id"]) for r in got}
    elif name in EACH:
        want = con.execute(f"SELECT count(*) FROM embeddings WHERE vec_id % {EACH[name]} = 0").fetchone()[0]
        assert len(got) == 10 * want
    elif name not in DERIVED:
        assert len(got) == con.execute(f"SELECT count(*) FROM {ROWS.get(name, 'documents')}").fetchone()[0]
    if name in SQL:
        answer = con.execute(SQL[name])
        names = sorted(c[0] for c in answer.description)
        assert sorted(df.columns) == names
        at = [[c[0] for c in answer.description].index(n) for n in names]
        assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == sorted((tuple(r[i] for i in at) for r in answer.fetchall()), key=repr)
