"""The index of stored URLs: exact answers, few files opened, replays, compaction."""
import pytest
from pyspark.sql import functions as F

from hirewire.operators import dedup as K
from hirewire.operators.url_index import UrlIndex, _power

from .conftest import rows


def _stored(spark, batches=100, each=60):
    """Batch b stores URLs b * each ... of its own."""
    return spark.range(0, batches * each).select(F.format_string("https://jobs.example.com/p/%d?x=ü", "id").alias("url"),
                                                 F.format_string("s-%09d", (F.col("id") / each).cast("int")).alias("batch_id"))


def _batch(spark, ids):
    return spark.createDataFrame([(f"https://jobs.example.com/p/{i}?x=ü", i) for i in ids] + [(None, -1)], "url string, v long")


def test_power():
    assert [_power(x) for x in (0, 0.2, 1, 1.1, 2, 3, 4, 5, 1025)] == [1, 1, 1, 2, 2, 4, 4, 8, 2048]


def test_hundred_batches_few_files(spark, tmp_path):
    index = UrlIndex(spark, str(tmp_path / "jobs"), keys_per_file=16)
    stored = _stored(spark)
    index.add(stored)
    segments = index.segments()
    assert len(segments) == 100 and sum(s.keys for s in segments) == 6000 and all(s.slots == 4 for s in segments)
    batch = _batch(spark, [*range(3000, 3020), *range(50_000, 50_030)])
    folders = index.files_for(batch.select("url"))
    assert len(folders) <= 0.1 * sum(s.slots for s in segments)
    new = index.new_only(batch)
    assert sorted(rows(new, "v")) == [-1, *range(50_000, 50_030)]
    assert sorted(rows(new, "v")) == sorted(rows(K.new_only(batch, stored), "v"))
    files = {f.split("/_url_index/")[1].rsplit("/", 1)[0] for f in new.inputFiles() if "_url_index" in f}
    assert files == {f"keys/segment={name}/slot={slot}" for name, slot in folders}
    assert rows(index.new_only(_batch(spark, [])), "v") == [-1]
    everything = index.new_only(_batch(spark, range(0, 6200, 7)))  # no false "new", whatever the number of hits
    assert sorted(rows(everything, "v")) == [-1, *[i for i in range(0, 6200, 7) if i >= 6000]]


def test_empty_index_and_replays(spark, tmp_path):
    target = str(tmp_path / "jobs")
    index = UrlIndex(spark, target)
    assert index.segments() == [] and sorted(rows(index.new_only(_batch(spark, [1, 2])), "v")) == [-1, 1, 2]
    two = _stored(spark, 2, 5)
    index.add(two)
    index.add(two.where("batch_id = 's-000000001'").limit(2))  # the second batch once more, with fewer rows
    assert sorted((s.batches, s.keys) for s in index.segments()) == [(["s-000000000"], 5), (["s-000000001"], 2)]
    mine = UrlIndex(spark, target, exclude_batch="s-000000001")
    assert sorted(rows(mine.new_only(_batch(spark, range(10))), "v")) == [-1, 5, 6, 7, 8, 9]
    index.add(spark.createDataFrame([(None, "s-2")], "url string, batch_id string"))
    assert len(index.segments()) == 2


def test_compaction_keeps_answers_and_readers(spark, tmp_path):
    target = str(tmp_path / "jobs")
    index = UrlIndex(spark, target, keys_per_file=64)
    index.add(_stored(spark, 30, 20))
    before = index.segments()
    reader = index.new_only(_batch(spark, range(590, 610)))  # planned on the version before
    index.compact(keep_last=4)
    after = index.segments()
    assert len(after) == 5 and sum(s.keys for s in after) == 600 and {b for s in after for b in s.batches} == {b for s in before for b in s.batches}
    assert sorted(rows(reader, "v")) == [-1, *range(600, 610)]
    assert sorted(rows(index.new_only(_batch(spark, range(0, 700, 3))), "v")) == [-1, *range(600, 700, 3)]
    index.add(_stored(spark, 30, 20).where("batch_id = 's-000000029'"))  # the newest batch may be replayed
    index.add(_stored(spark, 30, 20).where("batch_id = 's-000000003'"))  # one that was merged stays as it is
    assert sum(s.keys for s in index.segments()) == 600
    gone = index.vacuum(keep_versions=1)
    assert len(gone) == 27 and sorted(rows(index.new_only(_batch(spark, range(590, 605))), "v")) == [-1, *range(600, 605)]
    index.compact(keep_last=4)
    assert sum(s.keys for s in index.segments()) == 600


def test_two_writers(spark, tmp_path):
    index = UrlIndex(spark, str(tmp_path / "jobs"))
    index.add(_stored(spark, 1, 3))
    number, have = index._version()
    index.add(_stored(spark, 2, 3))
    with pytest.raises(RuntimeError, match="another writer"):
        index._commit(number, have)
    assert len(index.segments()) == 2


def test_sync_indexes_what_a_dead_run_left(spark, tmp_path):
    target = str(tmp_path / "jobs")
    _stored(spark, 3, 4).write.partitionBy("batch_id").parquet(target)
    index = UrlIndex(spark, target)
    index.sync(exclude="s-000000002")
    assert sorted(b for s in index.segments() for b in s.batches) == ["s-000000000", "s-000000001"]
    index.sync()
    assert len(index.segments()) == 3 and spark.read.parquet(target).count() == 12
