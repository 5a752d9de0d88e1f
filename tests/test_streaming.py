from datetime import timedelta

import pytest
from test_plans import AS_OF, NOW, bronze_rows, contents, measurement

from gaugeline.plans import facts
from gaugeline.sources import catalog
from gaugeline.streaming.facts import stream_facts


def test_stream_equals_batch(spark, tables, tmp_path):
    """Also when a batch's files reach the stream one by one, and in two goes."""
    docs = [measurement(NOW - timedelta(hours=h), float(h)) for h in range(60)]
    other = catalog.Tables(f"{tables.database}_batch")
    catalog.ensure_all(spark, other)
    portions = [[("a", 1, docs[:20]), ("a", 2, docs[:5])], [("b", 1, docs[10:50])]]
    for rows in portions:
        for target in (tables, other):
            for row in rows:
                catalog.append(bronze_rows(spark, [row]), target.bronze_measurements)
        facts.run_facts(spark, other, "", NOW, as_of=AS_OF)
        stream_facts(spark, tables, str(tmp_path / "stream"), NOW, AS_OF, files_per_trigger=1)
    assert contents(spark, tables.fact) == contents(spark, other.fact)
    assert contents(spark, tables.daily) == contents(spark, other.daily)
    assert spark.table(tables.staging).count() == 65
    stream_facts(spark, tables, str(tmp_path / "stream"), NOW, AS_OF)
    assert spark.table(tables.staging).count() == 65
    assert facts.pending_batches(spark, tables) == []
    spark.sql(f"DROP DATABASE {other.database} CASCADE")


def test_stream_after_batch_runs_and_a_replayed_batch(spark, tables, tmp_path, monkeypatch):
    """Readings with a NULL key come once, and each batch is logged once."""
    undated = {**measurement(NOW, 3.0), "period": None}
    catalog.append(bronze_rows(spark, [("a", 1, [undated])]), tables.bronze_measurements)
    facts.run_facts(spark, tables, "", NOW, as_of=AS_OF)
    catalog.append(bronze_rows(spark, [("b", 1, [undated])]), tables.bronze_measurements)

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(facts, "log_batches", fail)
        with pytest.raises(Exception, match="lost"):
            stream_facts(spark, tables, str(tmp_path / "stream"), NOW, AS_OF)
    stream_facts(spark, tables, str(tmp_path / "stream"), NOW, AS_OF)
    assert spark.table(tables.fact).count() == 2
    logged = spark.table(tables.batch_log).dropna(subset=["batch_id"]).collect()
    assert sorted(r.batch_id for r in logged) == ["a", "b"]
