import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporium.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    good = np.array([r.score for r in held if r.quality == 1])
    bad = np.array([r.score for r in held if r.quality == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert (good >= 0.7).mean() > 0.97 and np.mean([r.predicted == r.quality for r in held]) > 0.93
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)


def test_prior_and_non_negative_risk():
    rng = np.random.default_rng(3)
    positive = rng.normal(1.5, 1, (3000, 6)).astype(np.float32)
    mixed = np.concatenate([rng.normal(1.5, 1, (2100, 6)), rng.normal(-1.5, 1, (900, 6))]).astype(np.float32)
    prior = Q.estimate_prior(positive, mixed)
    assert prior == pytest.approx(0.7, abs=0.07)
    network = Q.fit(positive, mixed, prior, epochs=30)
    right = np.concatenate([network.score(mixed[:2100]) > .5, network.score(mixed[2100:]) < .5])
    assert right.mean() > 0.97


def test_odd_rows_labels_never_enter_scores(spark, documents):
    df, rows = documents
    ids = [i for i, _ in rows if i is not None and i < 200]
    labels = [(i, 1 if i % 4 else 0, 5) for i in ids] + [(None, 1, 5), (ids[0], None, 5), (7, 1, 5), (7, 0, 5)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, text int")
    got = Q.scores(df, labels).collect()
    assert len(got) == len(rows) and all(r.score is not None for r in got)
    assert all(not r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id in (900_001, 900_002)}) == 1  # null and empty text
    kept = Q.keep_good(df, labels)
    assert kept.columns == df.columns


def test_without_positives_everything_stays(spark, documents, no_documents):
    df, rows = documents
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.scores(df, none).agg(F.min("score")).first()[0] == 1.0
    assert Q.keep_good(df, none).count() == len(rows)
    assert Q.scores(no_documents, none).count() == 0
