from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as C
from emporium.llm import common, quality, simhash

from .test_exact_dedup import brute as exact
from .test_packing import check_pieces
from .test_simhash import Groups, fingerprint
from .test_suffix import marks

SF = "/root/testdata/sf0.001"


def test_stages_and_run_equal_brute_force(spark):
    """Every stage against its own input, and the whole run against the last stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for name, stage in C.STAGES:
        tables.append(common.materialize(stage(spark, tables[-1], SF), "stage"))
    rows = [[(r.doc_id, r.text) for r in t.select("doc_id", "text").collect()] for t in tables[:-1]]
    assert all(t.columns == columns for t in tables[:-1])

    score = {r.doc_id: r.score for r in quality.scores(docs, common.read_table(spark, SF, "labels")).collect()}
    assert sorted(rows[1]) == sorted(r for r in rows[0] if score[r[0]] >= 0.7)
    assert {i for i, _ in rows[2]} == {i for i, _, _, kept, _ in exact(rows[1]) if kept}

    groups = Groups(i for i, _ in rows[2])
    fps = [(i, fingerprint(t)) for i, t in rows[2]]
    for k, (i, a) in enumerate(fps):
        for j, b in fps[:k]:
            if (a ^ b).bit_count() <= 3:
                groups.join(i, j)
    assert sorted(i for i, _ in rows[3]) == sorted({groups.find(i) for i, _ in rows[2]})

    texts = [t.encode() for _, t in rows[3]]
    cut = {}
    for (i, _), text, starts in zip(rows[3], texts, marks(texts, C.PASSAGE_BYTES)):
        gone = [False] * len(text)
        for k, s in enumerate(starts):
            if s:
                gone[k:k + C.PASSAGE_BYTES] = [True] * C.PASSAGE_BYTES
        at, out = 0, []
        for c in text.decode():  # a character goes only if all its bytes do
            n = len(c.encode())
            out.append("" if all(gone[at:at + n]) else c)
            at += n
        cut[i] = "".join(out)
    assert dict(rows[4]) == cut

    # Of the passages of over 50 words that documents share, next to none is left.
    def windows(text):
        words = text.split()
        return {tuple(words[k:k + 51]) for k in range(len(words) - 50)}

    def shared(table):
        return {w for w, n in Counter(w for _, x in table for w in windows(x)).items() if n > 1}

    assert len(shared(rows[4])) < 0.05 * len(shared(rows[3])) + 1

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [(i, t.encode(x, add_special_tokens=False).ids + [1]) for i, x in rows[4]]
    check_pieces(tables[5].collect(), expected, 2048)
    whole = lambda df: sorted((r.doc_id, r.start, r.length, r.doc_tokens) for r in df.collect())
    got = C.run(spark, SF)
    check_pieces(got.collect(), expected, 2048)
    assert sum(r[2] for r in whole(got)) == sum(r[2] for r in whole(tables[5]))


def test_registered_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
