"""I4: many small batches merged into few files; replays, readers and the URL index go on as before."""
from pyspark.sql import functions as F

from hirewire.operators import sink as SK
from hirewire.operators.url_index import UrlIndex

from .conftest import rows

SCHEMA = "url string, v long, batch_id string"


def _rows(spark, batches, each=5, add=0):
    return spark.range(0, 40 * each).select(F.format_string("https://x/%d", "id").alias("url"), (F.col("id") + add).alias("v"),
                                            F.format_string("b %03d", (F.col("id") / each).cast("int")).alias("batch_id")) \
        .where(F.col("batch_id").isin(*[f"b {b:03d}" for b in batches]))


def _read(spark, path):
    return sorted(rows(SK.read_target(spark, path, SCHEMA), "url", "v", "batch_id"))


def test_compaction_and_replay(spark, tmp_path):
    path = str(tmp_path / "jobs")
    assert SK.read_target(spark, path, SCHEMA) is None
    SK.append(_rows(spark, range(20)), path)
    before = _read(spark, path)
    assert len(before) == 100
    early = SK.read_target(spark, path, SCHEMA)  # a reader that planned before
    assert SK.compact(spark, path, keep_last=4, schema=SCHEMA) == 16
    assert _read(spark, path) == before and early.count() == 100
    merged = [f for f in SK.read_target(spark, path, SCHEMA).inputFiles() if "_merged" in f]
    assert len(merged) == 1
    # a replay of a merged batch changes its own rows only, whether or not the old partitions are gone
    SK.append(_rows(spark, [3], add=1000), path)
    now = _read(spark, path)
    assert [r for r in now if r[2] != "b 003"] == [r for r in before if r[2] != "b 003"] and sorted(r[1] for r in now if r[2] == "b 003") == [1015, 1016, 1017, 1018, 1019]
    gone = SK.remove_merged(spark, path)
    assert len(gone) == 15 and "b 003" not in gone and _read(spark, path) == now
    SK.append(_rows(spark, [5], add=7), path)
    assert sorted(r[1] for r in _read(spark, path) if r[2] == "b 005") == [32, 33, 34, 35, 36] and len(_read(spark, path)) == 100
    # merged again, with batches that came later
    SK.append(_rows(spark, range(20, 26)), path)
    full = _read(spark, path)
    assert len(full) == 130
    assert SK.compact(spark, path, keep_last=2, schema=SCHEMA) == 10
    assert _read(spark, path) == full
    assert SK.compact(spark, path, keep_last=2, schema=SCHEMA) == 0
    assert len(SK.remove_merged(spark, path)) == 10 and _read(spark, path) == full
    SK.append(_rows(spark, range(26, 30)), path)
    full = _read(spark, path)
    assert SK.compact(spark, path, keep_last=2, schema=SCHEMA, most_folders=2) == 4 and _read(spark, path) == full
    assert len({f.split("/_merged/")[1].split("/")[0] for f in SK.read_target(spark, path, SCHEMA).inputFiles() if "_merged" in f}) == 1
    SK.remove_merged(spark, path)
    assert _read(spark, path) == full and len(full) == 150


def test_index_of_a_compacted_table(spark, tmp_path):
    """The index that is built after the merge finds the URLs of merged and of later batches."""
    path = str(tmp_path / "jobs")
    SK.append(_rows(spark, range(6)), path)
    SK.compact(spark, path, keep_last=1, schema=SCHEMA)
    SK.remove_merged(spark, path)
    index = UrlIndex(spark, path)
    index.sync()
    assert sorted(b for s in index.segments() for b in s.batches) == [f"b {b:03d}" for b in range(6)]
    batch = _rows(spark, [2, 5, 9]).select("url", "v")
    assert sorted(rows(index.new_only(batch), "v")) == [45, 46, 47, 48, 49]
