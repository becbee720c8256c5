"""Pipeline stages and operators on clashing names, null columns and empty tables."""
import random
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from hirewire.llm import embedding_dedup, quality, secret_scan, simhash, token_records, toxicity
from hirewire.llm.tokens import public_path
from tests.llm.conftest import DOCS

CLASHES = ["score", "predicted", "spans", "id", "fp", "_fp", "_row", "row", "low", "kept", "gone", "n_words", "base_failed", "n_removed_words", "_host", "_doc", "h", "d", "removed", "_new_text", "_t", "_w"]


def _corpus():
    draw = random.Random(21)
    words = [f"w{draw.randint(0, 10 ** 6):06d}" for _ in range(300)]
    return [(k, " ".join(draw.choice(words) for _ in range(40))) for k in range(60)]


def test_stages_keep_clashing_columns(spark, documents):
    """Each stage gives back the columns as they came, whatever their names, and the values of rows that it keeps."""
    rows = _corpus() + [(100, None), (None, None), (101, "")]
    rows.append((200, rows[0][1] + "\npassword = a8f5f167f44f4964e6c998dee827110c"))
    df = documents(rows)
    plain = {"toxicity": lambda d: toxicity.keep_clean(d, toxicity.Crf(constant=0.0)), "quality": quality.keep_good,
             "near_duplicates": simhash.keep_one, "secrets": lambda d: secret_scan.redact(d, secret_scan.train(d))}
    clashing = df.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHES])
    for name, stage in plain.items():
        want = Counter(map(tuple, stage(df).collect()))
        out = stage(clashing)
        assert out.columns == clashing.columns, name
        got = out.collect()
        assert Counter(tuple(r[c] for c in df.columns) for r in got) == want, name
        assert all(r[c] == f"{c}:{'none' if r['doc_id'] is None else r['doc_id']}" for r in got for c in CLASHES), name


def test_records_with_clashing_columns(spark, documents, tmp_path):
    df = documents(_corpus()[:9] + [(None, None), (3, "")])
    clashing = df.select("*", *[F.lit("x").alias(c) for c in ("id", "start", "n_tokens", "ids", "part", "file", "records")])
    path = public_path("word_bpe_49k.json")
    results = []
    for k, frame in enumerate((df, clashing)):
        folder = str(tmp_path / f"records-{k}")  # no scheme: one of Spark's default file system, here this machine's
        manifest = token_records.write_records(frame, folder, path, 2)
        results.append(sorted(map(tuple, token_records.read_records(manifest, folder, digest=True).collect()), key=str))
    assert results[0] == results[1] and len(results[0]) == 11


def test_embeddings_with_null_ids(spark):
    v = [1.0, 0.0, 0.5, 0.25]
    rows = [(None, v, 1), (7, v, 1), (9, [x * 2 for x in v], 1), (None, [0.0, 1.0, 0.0, 0.0], 1), (4, v, None), (5, None, 1), (6, [float("nan")] * 4, 1), (8, v, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rid", F.lit("clash")).withColumn("v", F.lit(0))
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == Counter({(None, 2, 7): 1, (7, 2, 7): 1, (9, 2, 7): 1, (None, 0, None): 1, (4, 0, 4): 1, (5, 0, 5): 1, (6, 0, 6): 1, (8, 0, 8): 1})


def test_pipeline_over_empty_and_null_tables(spark, tmp_path):
    labels = "doc_id long, toxic int, quality int"
    for k, rows in enumerate(([], [(None, None, None, None, None)] * 3)):
        folder = str(tmp_path / str(k))
        spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(None, None, None)] * k, labels).write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.count() == 0 and "sequence_id" in out.columns  # rows without a text fail the quality rules
