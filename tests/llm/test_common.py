from types import SimpleNamespace

from strata.llm import common


def test_tasks_give_free_arrow_memory_back_and_scans_hold_few_rows(monkeypatch):
    given, settings = [], {}
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: given.append(1)))
    frame = SimpleNamespace(
        sparkSession=SimpleNamespace(conf=SimpleNamespace(set=settings.__setitem__)),
        mapInArrow=lambda work, schema: list(work(iter([1, 2]))),
    )
    assert common.map_batches(frame, lambda batches: batches, "") == [1, 2]
    assert given == [1]
    assert int(settings["spark.sql.parquet.columnarReaderBatchSize"]) <= int(common.BATCH_ROWS) * 2
