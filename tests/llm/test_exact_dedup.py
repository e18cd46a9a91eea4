import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from emporium.llm import exact_dedup as X


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = 0
        for i in ids:
            mine = i == keep and not kept
            kept += mine
            out.append((i, keep, len(ids), mine, sha))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("files", [2, 100])
def test_equals_brute_force_over_several_batches(documents, files):
    df, rows = documents
    assert rows_of(X.exact_dedup(df, files_per_batch=files)) == brute(rows)


def test_full_bytes_decide_when_digests_clash(documents):
    df, rows = documents
    weak = lambda text: F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0"))
    assert rows_of(X.exact_dedup(df, digest=weak)) == brute(rows)


def test_more_hits_than_may_be_sent(documents, monkeypatch):
    df, rows = documents
    monkeypatch.setattr(X, "MOST_SENT", 0)
    assert rows_of(X.exact_dedup(df)) == brute(rows)


def test_kept_documents_have_all_columns(documents):
    df, rows = documents
    kept = X.drop_exact_copies(df)
    assert kept.columns == df.columns
    assert sorted([(r.doc_id, r.text or "") for r in kept.select("doc_id", "text").collect()], key=str) == sorted(
        {(i, next(t or "" for d, t in rows if d == i and hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
                                                                        .encode()).hexdigest() == sha))
         for i, _, _, k, sha in brute(rows) if k}, key=str)


def test_empty_table(no_documents):
    assert X.exact_dedup(no_documents).count() == 0
    assert X.drop_exact_copies(no_documents).columns == ["doc_id", "text"]
