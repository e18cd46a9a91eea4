"""Language-model scoring with an n-gram trie of Elias-Fano levels, sharded by context.

1. Tasks cut their documents into chunks, hash the words (64 bits) and store each chunk as numbers
   of its own distinct words; the distinct words go, with training counts, to word shards.
2. A word shard sums the counts, numbers its words and answers every chunk.
3. Chunks send their distinct bigrams with training counts to trie shards, chosen by the context
   (a frequent context is spread over several shards by its successors). A trie shard builds its
   trie over the bigrams of the training texts: words, then successors relative to the context, with 8-bit
   codes of smoothed log probabilities and backoff weights; writes it to a memory-mapped file; and
   answers all bigrams by successor search.
4. Chunks gather the answers and sum them by document.

The model is a bigram with Dirichlet smoothing, P(w|u) = (c(uw) + m P(w)) / (c(u) + m), and P(w) is
the base formula, so an unseen bigram has the backoff weight m / (c(u) + m) times P(w). The end of
a text is a token, and the context of the first word. Chunks and shards are of bounded size; their number grows with
the input.

Defined cases: null and empty texts are the end token alone; a null doc_id belongs to the training
texts; repeated rows count each; without training texts N and V are 0 and every token has the base
probability of an unknown one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .common import byte_slices, id_and_text, materialize, text_bytes, to_batch
from .eliasfano import NgramTrie
from .sketch import pack_sorted, unpack_sorted

LANE = rolling.Hasher(701)
END = np.uint64(1)  # the end token's place among the word hashes
CHUNK_BYTES = 12 << 20
SHARD_BYTES = 16 << 20
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")
# chunk and shard; one row is a chunk's body or a message between a chunk and a shard.
MESSAGE = "chunk long, shard long, kind int, data binary"


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, the bytes of the numbers plane by plane."""
    import zstandard

    parts = [len(arrays).to_bytes(2, "little")]
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
        code = a.dtype.str.encode()
        parts += [len(code).to_bytes(1, "little"), code, len(a).to_bytes(8, "little"), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def expand(data: bytes) -> list[np.ndarray]:
    import zstandard

    raw, out, at = zstandard.ZstdDecompressor().decompress(data), [], 2
    for _ in range(int.from_bytes(raw[:2], "little")):
        kind = np.dtype(raw[at + 1:at + 1 + raw[at]].decode())
        at += 1 + raw[at]
        n = int.from_bytes(raw[at:at + 8], "little")
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at + 8).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += 8 + n * kind.itemsize
    return out


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text followed by the end token, and tokens per text."""
    hashes, count = rolling.word_hashes([t.lower() for t in texts], LANE)
    hashes = np.maximum(hashes, np.uint64(2))
    out = np.full(len(hashes) + len(texts), END)
    last = np.cumsum(count + 1) - 1
    word = np.ones(len(out), bool)
    word[last] = False
    out[word] = hashes
    return out, count + 1


class Chunk:
    """Tokens of a chunk as places in its sorted distinct hashes; texts by ids, fold and length."""

    def __init__(self, words: int, places: np.ndarray, lengths: np.ndarray, ids: np.ndarray, known_id: np.ndarray,
                 held_out: np.ndarray):
        self.words, self.places, self.lengths = words, places, lengths
        self.ids, self.known_id, self.held_out = ids, known_id, held_out

    def pack(self) -> bytes:
        # By falling frequency most numbers are small, which compresses well.
        counts = np.bincount(self.places, minlength=self.words)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(self.words, np.uint32)
        rank[order] = np.arange(self.words, dtype=np.uint32)
        return squeeze(counts.astype(np.uint32), rank[self.places], self.lengths.astype(np.int64), self.ids,
                       self.known_id, self.held_out)

    @classmethod
    def unpack(cls, data: bytes) -> Chunk:
        counts, ranks, lengths, ids, known_id, held_out = expand(data)
        order = np.argsort(-counts.astype(np.int64), kind="stable")
        return cls(len(counts), order[ranks], lengths, ids, known_id, held_out)

    def train_tokens(self) -> np.ndarray:
        return np.repeat(~self.held_out, self.lengths)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct ``(context, word)`` as one number each, the bigram of each token, training counts."""
        end = 0  # the end token has the least hash and every text has one
        before = np.concatenate([[end], self.places[:-1]]) if len(self.places) else self.places
        pairs, which = np.unique(before.astype(np.int64) * self.words + self.places, return_inverse=True)
        return pairs, which, np.bincount(which, weights=self.train_tokens(), minlength=len(pairs)).astype(np.int64)


def streamed(key: int, run: Callable[[int, list[tuple]], Iterator[tuple]], schema) -> Callable:
    """A mapInArrow function that calls ``run(key, rows)`` for each run of equal values in column ``key``."""

    def go(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> pa.RecordBatch:
            rows = list(run(now, held))
            return to_batch(schema, dict(zip([f.name for f in schema], zip(*rows) if rows else [()] * len(schema.fields))))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[key] != now:
                    if held:
                        yield done()
                    now, held = row[key], []
                held.append(row)
        if held:
            yield done()

    return go


def by(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of one key together and in order, read as a stream."""
    return rows.select("chunk", "shard", "kind", "data").repartition(keys[0]).sortWithinPartitions(*keys)


def chunked(docs: DataFrame, folds: int, held_out: int, shards: int) -> DataFrame:
    rows = id_and_text(docs).withColumn("out", F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_out, F.lit(False)))
    schema = rows.sparkSession.createDataFrame([], MESSAGE).schema
    shift = np.uint64(64 - shards.bit_length() + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list[tuple] = []
        size = 0

        def done() -> pa.RecordBatch:
            hashes, lengths = map(np.concatenate, zip(*(h[:2] for h in held)))
            ids, known, out = map(np.concatenate, zip(*(h[2:] for h in held)))
            distinct, places = np.unique(hashes, return_inverse=True)
            chunk = Chunk(len(distinct), places, lengths, ids, known, out)
            counts = np.bincount(places, weights=chunk.train_tokens(), minlength=len(distinct)).astype(np.uint32)
            shard = (distinct >> shift).astype(np.int64) if shards > 1 else np.zeros(len(distinct), np.int64)
            cut = np.searchsorted(shard, np.arange(shards + 1))
            found = [(number, -1, 0, chunk.pack())]
            for s in np.flatnonzero(np.diff(cut)):
                part = slice(cut[s], cut[s + 1])
                found.append((number, int(s), 1, squeeze(distinct[part], counts[part])))
            return to_batch(schema, dict(zip(("chunk", "shard", "kind", "data"), zip(*found))))

        for batch in batches:
            ids = batch.column(0)
            known = ~np.asarray(ids.is_null())
            values = ids.fill_null(0).to_numpy()
            outs = np.asarray(batch.column(2).to_pylist(), bool)
            texts = text_bytes(batch.column(1))
            for a, b in byte_slices([len(t) for t in texts], rolling.SLICE):
                hashes, lengths = token_hashes(texts[a:b])
                held.append((hashes, lengths, values[a:b], known[a:b], outs[a:b]))
                size += sum(map(len, texts[a:b])) + b - a
                if size >= CHUNK_BYTES:
                    yield done()
                    held, size, number = [], 0, number + 1
        if held:
            yield done()

    return materialize(rows.mapInArrow(run, schema), "lm-chunks")


def word_counts(shard: int, rows: list[tuple]) -> Iterator[tuple]:
    """Word shard: numbers and training counts for each chunk; its own totals as one more row."""
    parts = [expand(r[3]) for r in rows]
    distinct, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.bincount(which, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
    at = 0
    for r, (hashes, _) in zip(rows, parts):
        mine = which[at:at + len(hashes)]
        at += len(hashes)
        places = pack_sorted(mine)
        yield r[0], shard, 0, len(places).to_bytes(8, "little") + places + squeeze(counts[mine])
    totals = np.array([len(distinct), (counts > 0).sum(), counts.sum()], np.int64)
    yield -1, shard, 0, totals.tobytes()


class Vocabulary:
    """What the word shards' totals say: first number of each shard, distinct words, tokens."""

    def __init__(self, totals: list[tuple[int, bytes]], smoothing: float):
        sizes = {s: np.frombuffer(t, np.int64) for s, t in totals}
        self.first, n = {}, 0
        for s in sorted(sizes):
            self.first[s] = n
            n += int(sizes[s][0])
        self.distinct = sum(int(v[1]) for v in sizes.values())
        self.tokens = sum(int(v[2]) for v in sizes.values())
        self.smoothing = smoothing
        self.number = np.uint32 if n < 1 << 32 else np.uint64
        self.count = np.uint32 if self.tokens < 1 << 32 else np.uint64  # of a word in all training texts

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the base probability."""
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def answers(self, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """A chunk's words: number and training count, in the order of their hashes."""
        numbers, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in sorted(rows, key=lambda r: r[1]):
            n = 8 + int.from_bytes(r[3][:8], "little")
            numbers.append(unpack_sorted(r[3][8:n]) + self.first[r[1]])
            counts.append(expand(r[3][n:])[0])
        return np.concatenate(numbers), np.concatenate(counts)


def spread(numbers: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (numbers.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(20)


def bigram_shards(u: np.ndarray, w: np.ndarray, c_u: np.ndarray, tokens: int, shards: int) -> np.ndarray:
    """A context goes to one shard, or by successor to as many as its share of the tokens asks for."""
    ways = np.minimum(shards, 1 + 4 * shards * c_u // max(1, tokens)).astype(np.uint64)
    return ((spread(u, 1) + spread(w, 2) % ways) % np.uint64(shards)).astype(np.int64)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes and the 256 values they stand for."""
    lo, hi = (float(x.min()), float(x.max())) if len(x) else (0.0, 0.0)
    book = np.linspace(lo, hi, 256)
    step = (hi - lo) / 255 or 1.0
    return np.rint((x - lo) / step).astype(np.uint8), book


def question(vocabulary: Vocabulary, numbers: np.ndarray, counts: np.ndarray, u: np.ndarray, w: np.ndarray,
             n: np.ndarray) -> bytes:
    """A chunk's bigrams for one shard: contexts and words with their training counts, and the bigrams' own in the chunk."""
    contexts, each = np.unique(u, return_counts=True)
    # Bigrams are in order of their context, so its words follow each other.
    return squeeze(numbers[contexts].astype(vocabulary.number), counts[contexts].astype(vocabulary.count),
                   each.astype(np.uint32), numbers[w].astype(vocabulary.number),
                   counts[w].astype(vocabulary.count), n.astype(np.uint32))


def answer_bigrams(vocabulary: Vocabulary) -> Callable[[int, list[tuple]], Iterator[tuple]]:
    m = vocabulary.smoothing

    def run(shard: int, rows: list[tuple]) -> Iterator[tuple]:
        parts = [expand(r[3]) for r in rows]  # contexts, their counts, bigrams of each, words, their counts, in training
        u = np.concatenate([np.repeat(p[0], p[2]) for p in parts]).astype(np.int64)
        c_u = np.concatenate([np.repeat(p[1], p[2]) for p in parts]).astype(np.int64)
        w, c_w, n = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (3, 4, 5))
        # Level 0: the words of this shard, by number; a bigram is a context's node and a word's node.
        words, place = np.unique(np.concatenate([u, w]), return_inverse=True)
        counts = np.zeros(len(words), np.int64)
        counts[place] = np.concatenate([c_u, c_w])
        pairs, which = np.unique(place[:len(u)] * len(words) + place[len(u):], return_inverse=True)
        seen = np.bincount(which, weights=n).astype(np.int64)
        trained = np.flatnonzero(seen)
        context, word = np.divmod(pairs[trained], len(words))
        single = vocabulary.base(counts)
        smoothed = (seen[trained] + m * 10 ** single[word]) / (counts[context] + m)
        values, books = zip(*map(quantise, (single, np.log10(smoothed))))
        weight, weights = quantise(np.log10(m / (counts + m)))
        trie = NgramTrie.build([words[:, None], np.stack([words[context], word], 1)], list(values), [weight],
                               len(words)).mapped()

        ask_u, ask_w = np.divmod(pairs, len(words))
        root = np.zeros(len(words), np.int64)
        node = trie.find(0, root, words)
        at = trie.find(1, node[ask_u], node[ask_w])
        low, high = trie.levels
        answer = weights[low["backoff"][node[ask_u]]] + books[0][low["value"][node[ask_w]]]
        hit = at >= 0
        answer[hit] = books[1][high["value"][at[hit]]]
        answer = np.maximum(np.rint(answer * 1000), -32767).astype(np.int16)[which]
        begin = 0
        for r, p in zip(rows, parts):
            k = len(p[3])
            yield r[0], shard, 1, squeeze(answer[begin:begin + k])
            begin += k

    return run


def score_texts(docs: DataFrame, folds: int = 5, held_out: int = 1, smoothing: float = 100.0) -> DataFrame:
    """One row per document: base score from the counts, and the score of the trie's model."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))))).first()[0] or 0
    shards = 1 << max(2, (int(size) // SHARD_BYTES).bit_length())
    message = spark.createDataFrame([], MESSAGE).schema
    result = spark.createDataFrame([], RESULT).schema

    chunks = chunked(docs, folds, held_out, shards)
    counted = materialize(by(chunks.filter("kind = 1"), "shard", "chunk")
                          .mapInArrow(streamed(1, word_counts, message), message), "lm-words")
    totals = counted.filter("chunk = -1").select("shard", "data").collect()  # one row of three numbers a shard
    vocabulary = Vocabulary([(r["shard"], bytes(r["data"])) for r in totals], smoothing)
    bodies = chunks.filter("kind = 0").withColumn("kind", F.lit(9))
    answered = counted.filter("chunk >= 0")

    def sorted_bigrams(rows: list[tuple]):
        """The chunk, its words, its bigrams, and their order by shard, context and word number."""
        chunk = Chunk.unpack(rows[-1][3])
        numbers, counts = vocabulary.answers([r for r in rows if r[2] == 0])
        pairs, which, n = chunk.bigrams()
        u, w = np.divmod(pairs, max(1, chunk.words))
        shard = bigram_shards(numbers[u], numbers[w], counts[u], vocabulary.tokens, shards)
        return chunk, numbers, counts, u, w, which, n, shard, np.argsort(shard, kind="stable")

    def ask(number: int, rows: list[tuple]) -> Iterator[tuple]:
        _, numbers, counts, u, w, _, n, shard, order = sorted_bigrams(rows)
        u, w, n, shard = u[order], w[order], n[order], shard[order]
        cut = np.searchsorted(shard, np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cut)):
            a, b = cut[s], cut[s + 1]
            yield number, int(s), 2, question(vocabulary, numbers, counts, u[a:b], w[a:b], n[a:b])

    def finish(number: int, rows: list[tuple]) -> Iterator[tuple]:
        chunk, _, counts, _, _, which, _, shard, order = sorted_bigrams(rows)
        answers = np.concatenate([np.zeros(0, np.int16)] + [
            expand(r[3])[0] for r in sorted((r for r in rows if r[2] == 1), key=lambda r: r[1])])
        log10 = np.empty(len(order))
        log10[order] = answers / 1000
        first = np.cumsum(chunk.lengths) - chunk.lengths
        c = counts[chunk.places]
        sums = [np.add.reduceat(x, first) for x in ((c > 0).astype(np.int64), vocabulary.base(c), log10[which])]
        for doc_id, known, out, n, k, base, score in zip(*(x.tolist() for x in (
                chunk.ids, chunk.known_id, chunk.held_out, chunk.lengths, *sums))):
            yield doc_id if known else None, out, n, k, vocabulary.tokens, base, score

    asked = by(answered.unionByName(bodies), "chunk", "kind").mapInArrow(streamed(0, ask, message), message)
    replies = by(asked, "shard", "chunk").mapInArrow(streamed(1, answer_bigrams(vocabulary), message), message)
    return (by(answered.unionByName(replies).unionByName(bodies), "chunk", "kind")
            .mapInArrow(streamed(0, finish, result), result))
