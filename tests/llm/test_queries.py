import duckdb

from reshelve.llm import queries


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    found = entry.queries()
    assert all(any(name.startswith(f"op{n}_") for name in found) for n in range(1, 14))
    assert "pipeline" in found and set(queries.statements()) <= set(found)


def test_sql(spark, folder):
    connection = duckdb.connect()
    connection.execute(f"create view documents as from '{folder}/documents.parquet'")
    for name, sql in queries.statements().items():
        frame = queries.registered()[name](spark, folder)
        expected = connection.execute(sql)
        columns = [d[0] for d in expected.description]
        assert sorted(columns) == sorted(frame.columns)
        assert sorted(map(str, expected.fetchall())) == sorted(
            str(tuple(r)) for r in frame.select(*columns).collect())
