"""op9's shards as files: whole records, and results that come from what is stored."""

from collections import Counter

from gridloom.llm import queries, sharding


def test_files(spark, sf, monkeypatch, tmp_path):
    path = str(tmp_path / "shards")
    monkeypatch.setattr(queries, "new_path", lambda *_: path)
    docs = queries.table(spark, sf, "documents")
    got = queries.op9_sharding(spark, sf)
    expected = sharding.shard_documents(docs)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.select(*got.columns).collect()))
    stored = sharding.read_shards(spark, path, docs.schema)
    assert Counter(map(tuple, stored.select(*expected.columns).collect())) == Counter(map(tuple, expected.collect()))
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == [f"shard={k}" for k in range(8)]
