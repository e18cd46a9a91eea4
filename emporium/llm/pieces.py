"""Subword encoding by backtracking, exact for merge-type (BPE) piece models, and decoding.

Longest matches come from one Aho-Corasick automaton over the pieces. The encoder walks the text
left to right, keeps a token only if it is compatible with the one before it (re-merging the
two strings, here by taking their merges back, gives the same two tokens), tries the next shorter prefix otherwise, and steps
back when none is left; a bit field holds the positions from which no encoding goes on. A
segment that no piece can cross is encoded on its own, and the ids of segments are kept in a
bounded table.

Defined cases: null and empty texts have no ids and decode to the empty text; a null doc_id
stays null; repeated rows give repeated rows; an empty table gives no rows; extra columns are
ignored; a text without any blank is one segment, encoded in memory linear in its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_slices, id_and_text, text_bytes, to_batch

SPACE = "▁"  # the blank in pieces
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceCodec:
    """Encoder and decoder of one piece model."""

    def __init__(self, path: str, keep_segments: int = 150_000, keep_pairs: int = 2_000_000):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                                             or model.is_unused(i))]
        if model.normalize("a  ﬁ ") != SPACE + "a" + SPACE * 2 + "ﬁ" + SPACE:
            raise ValueError("the model's normaliser rewrites texts; only blanks may become pieces' blanks")
        self.score = {names[i]: model.get_score(i) for i in plain}
        self.id_of = {names[i]: i for i in plain}
        self.byte_id = {int(names[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.output = [p.replace(SPACE, " ").encode() for p in names]
        for b, i in self.byte_id.items():
            self.output[i] = bytes([b])
        self.is_byte = [model.is_byte(i) for i in range(n)]
        for i in range(n):
            if model.is_control(i):
                self.output[i] = b""
        self.output[self.unknown] = " ⁇ ".encode()

        # Pieces that merging can reach from their own characters; a token is its piece's id.
        kept = {p: parts for p in self.score for parts in [self.merge(p)] if parts[-1] == p}
        self.automaton = ahocorasick.Automaton()
        for p in kept:
            self.automaton.add_word(p, self.id_of[p])
        self.automaton.make_automaton()
        self.length = [len(p) for p in names] + [1]  # the last is NO_PIECE, any character without a piece
        self.none = n
        if n >= 1 << 15:
            raise ValueError("pairs of tokens are packed into 30 bits")
        self.shorter = [-1] * (n + 1)  # the next shorter token that begins alike
        for p in kept:
            self.shorter[self.id_of[p]] = next((self.id_of[p[:k]] if p[:k] in kept else n
                                                for k in range(len(p) - 1, 0, -1) if k == 1 or p[:k] in kept), -1)
        # The two parts of the last merge of each token, and the order of merges.
        self.parts = [(-1, -1)] * (n + 1)
        for p, parts in kept.items():
            if len(p) > 1:
                self.parts[self.id_of[p]] = (self.id_of[parts[0]], self.id_of[parts[1]])
        order = sorted((p for p in self.score if len(p) > 1), key=lambda p: -self.score[p])
        self.rank = [-1] * (n + 1)  # single characters are there from the start
        for i, p in enumerate(order):
            self.rank[self.id_of[p]] = i if i == 0 or self.score[order[i - 1]] != self.score[p] else (
                self.rank[self.id_of[order[i - 1]]])
        self.names = [*names, ""]
        self.digits = [str(i) for i in range(n)]

        letters = {c for p in self.score for c in p}
        apart = "".join(c for c in "\n\t\r" if c not in letters)
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.score)
        self.segments = (re.compile(".+", re.S) if crossing else
                         re.compile(f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+|[{apart}]" if apart
                                    else f"{SPACE}*[^{SPACE}]+|{SPACE}+"))
        self.keep_segments, self.keep_pairs = keep_segments, keep_pairs
        # Two generations: what is asked for again outlives the older one.
        self.known_segments: dict[str, tuple[str, tuple[int, ...]]] = {}
        self.old_segments: dict[str, tuple[str, tuple[int, ...]]] = {}
        self.known_pairs: dict[int, bool] = {}

    def merge(self, text: str) -> list[str]:
        """A short string by merging best pairs first, the leftmost of equal ones: the parts of its last
        merge and the whole, if it merges to one piece; else the pieces that are left."""
        parts, score = list(text), self.score
        last: list[str] = []
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            last = parts[at:at + 2]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [*last, *parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' characters side by side gives the two tokens again.

        The merges are taken back from the last one on. While two parts lie side by side at the border, a piece of
        both would have been merged if it comes before the merge that took one of them away."""
        if left == self.none or right == self.none:
            return True
        names, rank, parts, piece = self.names, self.rank, self.parts, self.id_of
        limit = len(names)
        while True:
            both = piece.get(names[left] + names[right])
            if both is not None and rank[both] < limit:
                return False
            if rank[left] > rank[right]:
                limit, left = rank[left], parts[left][1]  # the left part's own merge goes first among equals
            elif rank[right] >= 0:
                limit, right = rank[right] + 1, parts[right][0]
            else:
                return True

    def tokens(self, segment: str) -> list[int]:
        n, length, shorter, pairs = len(segment), self.length, self.shorter, self.known_pairs
        longest = [self.none] * n  # a character without a piece stands for itself
        for end, token in self.automaton.iter(segment):
            longest[end - length[token] + 1] = token  # longer ones end later
        if length[longest[0]] == n:
            return longest[:1]
        failed = None  # bit field of the positions from which no encoding goes on
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                end = at + length[token]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    if last < 0:
                        break
                    pair = last << 15 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= self.keep_pairs:
                            pairs.clear()
                        fits = pairs[pair] = self.compatible(last, token)
                    if fits:
                        break
                token = shorter[token]
            else:
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                if not out:
                    raise ValueError("no encoding found")
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1
                token = shorter[token]
                continue
            out.append(token)
            at, last = end, token
            token = longest[at] if at < n else -1
        return out

    def ids(self, segment: str) -> tuple[int, ...]:
        found = self.tokens(segment)
        if self.none not in found:
            return tuple(found)
        out: list[int] = []
        at = 0
        for t in found:
            if t != self.none:
                out.append(t)
            elif self.byte_id:
                out.extend(self.byte_id[b] for b in segment[at].encode())
            else:
                out.append(self.unknown)
            at += self.length[t]
        return tuple(out)

    def segment_ids(self, text: str) -> list[tuple[str, tuple[int, ...]]]:
        """Per segment its ids, also as decimal text."""
        if not text:
            return []
        known, old, digits, out = self.known_segments, self.old_segments, self.digits, []
        for s in self.segments.findall(SPACE + text.replace(" ", SPACE)):
            entry = known.get(s)
            if entry is None:
                entry = old.get(s)
                if entry is None:
                    ids = self.ids(s)
                    entry = (",".join([digits[i] for i in ids]), ids)
                if len(s) < 200:
                    if len(known) >= self.keep_segments:
                        old = self.old_segments = known
                        known = self.known_segments = {}
                    known[s] = entry
            out.append(entry)
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(ids for _, ids in self.segment_ids(text)))

    def decode(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        raw = b"".join(map(self.output.__getitem__, ids))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        first = next((i for i in ids if self.output[i]), None)
        dummy = first is not None and not self.is_byte[first] and first != self.unknown and text[:1] == " "
        return text[1:] if dummy else text

    def _decode_runs(self, ids: list[int]) -> str:
        """Byte pieces that are no UTF-8 become one replacement character each."""
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.output[i]
                continue
            while run:
                for k in range(1, 5):
                    try:
                        out.append(run[:k].decode())
                        run = run[k:]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    run = run[1:]
            if i is not None:
                out.append(self.output[i].decode())
        return "".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec for each worker process and model."""
    return PieceCodec(path)


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the text decoded from them."""
    rows = id_and_text(docs)
    schema = rows.sparkSession.createDataFrame([], SCHEMA).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
            for a, b in byte_slices([len(t) for t in texts], 16 << 20):
                out: dict[str, list] = {f.name: [] for f in schema}
                for doc_id, text in zip(doc_ids[a:b], texts[a:b]):
                    parts = c.segment_ids(text.decode())
                    ids = list(chain.from_iterable([p[1] for p in parts]))
                    out["doc_id"].append(doc_id)
                    out["n_tokens"].append(len(ids))
                    out["ids_sha256"].append(hashlib.sha256(",".join([p[0] for p in parts]).encode()).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
                yield to_batch(schema, out)

    return rows.mapInArrow(run, schema)
