"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

The distinct words of a batch are concatenated and indexed by a suffix array; every piece of the vocabulary is found in it
by binary search; its occurrences are edges of a lattice, which are sorted by position and relaxed. For BPE the
edge that ends a prefix is the one whose piece can stand after the piece before it: two pieces can stand side
by side if merging their characters gives back just the two.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.shelf import give_back, portions, record_batches, table, text_or_empty

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
WORDS = re.compile(f"{SPACE}+[^{SPACE}]*")
BATCH_CHARS = 2_000_000  # text whose new words are learned together
INDEX_CHARS = 400_000  # of new words that are indexed together: an edge takes some 50 bytes, and there are several a character
KNOWN_WORDS = 125_000  # words in each of the two generations whose pieces a task remembers
MAX_MODEL_PIECES = 1_000_000  # the model is broadcast: refuse what is larger


@dataclass(frozen=True)
class PieceModel:
    """Pieces in order of their ids, and what a BPE model with byte fallback needs to know of them."""

    pieces: list[str]
    scores: dict[str, float]  # of the pieces that merging can give
    ids: dict[str, int]
    byte_ids: list[int]

    def plain(self) -> tuple:
        return self.pieces, self.scores, self.ids, self.byte_ids

    @staticmethod
    def load(path: str = MODEL) -> PieceModel:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rules = proto.normalizer_spec
        if (
            proto.trainer_spec.model_type != proto.trainer_spec.BPE or not proto.trainer_spec.byte_fallback
            or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix
        ):
            raise ValueError("only BPE models with byte fallback that leave the text as it is are supported")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        if n > MAX_MODEL_PIECES:
            raise ValueError("the vocabulary is too large to broadcast")
        pieces = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece holds a word boundary inside; words can't be encoded apart")
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        return PieceModel(
            pieces, {pieces[i]: model.get_score(i) for i in plain}, {pieces[i]: i for i in plain}, byte_ids
        )


def merge(text: str, scores: dict[str, float], stop_across: int | None = None) -> list[str] | None:
    """Plain BPE: merge the best neighbours, the leftmost of equals, until none is a piece.

    With stop_across, None as soon as a merge crosses that place.
    """
    parts, ends = list(text), list(range(1, len(text) + 1))
    while True:
        best, at = None, -1
        for i in range(len(parts) - 1):
            s = scores.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if best is None:
            return parts
        if ends[at] == stop_across:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del ends[at]


def suffix_order(code: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in order of their first `depth` characters at least, by doubling."""
    present = np.zeros(0x110001, dtype=bool)
    present[code] = True
    small = np.cumsum(present)[code]  # from 1; 0 stands for the end
    bits = int(small.max()).bit_length()
    length = max(1, 63 // bits)  # as many characters as one number holds are compared at once
    padded = np.concatenate([small, np.zeros(length, dtype=np.int64)])
    key = np.zeros(len(code), dtype=np.int64)
    for d in range(length):
        key = key << bits | padded[d : d + len(code)]
    order = np.argsort(key)
    while length < depth:
        ordered = key[order]
        rank = np.empty(len(key), dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        after = np.full(len(rank), -1, dtype=np.int64)
        after[:-length] = rank[length:]
        key = rank * (len(rank) + 1) + after + 1
        order = np.argsort(key)
        length *= 2
    return order


class Encoder:
    """Encodes batches of texts; remembers words up to a bound."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        own = list(model.ids)
        if not own:
            raise ValueError("the model has no pieces")
        self.strings = model.pieces
        self.length = np.array([len(p) for p in own], dtype=np.int32)
        self.token = np.array([model.ids[p] for p in own], dtype=np.int32)
        self.depth = int(self.length.max())
        self.code = np.zeros((len(own), self.depth), dtype=np.int64)
        for i, p in enumerate(own):
            self.code[i, : len(p)] = [ord(c) for c in p]
        self.pairs: dict[int, bool] = {}
        # A piece that merging its own characters does not give is never used.
        self.usable = np.array([len(merge(p, model.scores)) == 1 for p in own])

    def _string(self, token: int) -> str:
        return self.strings[token] if token >= 0 else chr(-token - 2)

    def _can_meet(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, back = np.unique((left.astype(np.int64) << 32) + right, return_inverse=True)
        known = self.pairs
        if len(known) > 400_000:
            known.clear()
        keys = keys.tolist()
        out = np.array([-1 if ok is None else ok for ok in map(known.get, keys)], dtype=np.int8)
        for i in np.flatnonzero(out < 0).tolist():
            right_token = (keys[i] & 0xFFFFFFFF) - ((keys[i] & 0x80000000) << 1)
            a, b = self._string((keys[i] - right_token) >> 32), self._string(right_token)
            out[i] = known[keys[i]] = merge(a + b, self.model.scores, len(a)) is not None
        return out[back].astype(bool)

    def _edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, token, length) of every piece wherever it occurs, and of every character that is no piece."""
        order = suffix_order(text, self.depth).astype(np.int32)
        padded = np.concatenate([text, np.full(self.depth, -1, dtype=np.int64)])
        low = np.zeros(len(self.token), dtype=np.int64)
        high = np.where(self.usable, len(order), 0)
        for d in range(self.depth):
            use = np.flatnonzero((self.length > d) & (low < high))
            want, at = self.code[use, d], padded[d:]
            for upper in (False, True):
                a, b = low[use].copy(), high[use].copy()
                while (a < b).any():
                    mid = (a + b) >> 1
                    seen = at[order[np.minimum(mid, len(order) - 1)]]
                    right = ((seen <= want) if upper else (seen < want)) & (a < b)
                    a, b = np.where(right, mid + 1, a), np.where(right | (a >= b), b, mid)
                if upper:
                    high[use] = a
                else:
                    new_low = a
            low[use] = new_low
        many = np.maximum(high - low, 0)
        entry = np.repeat((low - np.concatenate([[0], np.cumsum(many)[:-1]])).astype(np.int32), many)
        entry += np.arange(len(entry), dtype=np.int32)
        start, token, length = order[entry], np.repeat(self.token, many), np.repeat(self.length, many)
        single = np.ones(len(text), dtype=bool)
        single[start[length == 1]] = False
        single[text == 0x110000] = False  # the mark between words
        alone = np.flatnonzero(single).astype(np.int32)
        return (
            np.concatenate([start, alone]), np.concatenate([token, (-text[alone] - 2).astype(np.int32)]),
            np.concatenate([length, np.ones(len(alone), dtype=np.int32)]),
        )

    def _relax(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of all words, one after the other, and how many each has; no word starts with two blanks."""
        text = np.frombuffer("\n".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        sizes = np.array([len(w) for w in words])
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        text[begin[1:] - 1] = 0x110000
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes + 1)[: len(text)]
        start, token, length = self._edges(text)
        end = start + length  # a place between characters is named by the character after it
        offset = end - begin.astype(np.int32)[word[start]]
        order = np.argsort(offset.astype(np.uint16) if offset.max(initial=0) < 1 << 16 else offset, kind="stable")
        del length
        start, token, end, offset = start[order], token[order], end[order], offset[order]
        unset = -(1 << 30)
        last = np.full(len(text) + 1, unset, dtype=np.int32)
        at_begin = np.zeros(len(text) + 1, dtype=bool)
        at_begin[begin] = True
        cuts = np.flatnonzero(np.diff(offset, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            s, t, e = start[a:b], token[a:b], end[a:b]
            ok = at_begin[s]
            inner = np.flatnonzero(~ok & (last[s] != unset))
            if len(inner):
                ok[inner] = self._can_meet(last[s[inner]], t[inner])
            last[e[ok]] = t[ok]
        width = dict(zip(self.token.tolist(), self.length.tolist()))
        table_ = np.ones(len(self.strings), dtype=np.int64)
        table_[list(width)] = list(width.values())
        found, place, live = [], begin + sizes, np.arange(len(words))
        while len(live):
            t = last[place[live]]
            found.append((live, t))
            place[live] -= np.where(t >= 0, table_[np.maximum(t, 0)], 1)
            live = live[place[live] > begin[live]]
        who = np.concatenate([w for w, _ in found][::-1])
        what = np.concatenate([t for _, t in found][::-1])
        return what[np.argsort(who, kind="stable")], np.bincount(who, minlength=len(words))

    def _ids(self, tokens) -> bytes:
        out = []
        for t in tokens:
            if t >= 0:
                out.append(t)
            else:
                out += [self.model.byte_ids[b] for b in chr(-t - 2).encode("utf-8", "replace")]
        return np.array(out, dtype=np.int32).tobytes()

    def _learn(self, words: list[str]) -> None:
        spaced = [w for w in words if w.startswith(SPACE * 2)]
        plain = [w for w in words if not w.startswith(SPACE * 2)]
        for w in spaced:  # runs of blanks are pieces of equal rank, which only merging in order settles
            parts = (merge_long if len(w) > 2 * self.depth else merge)(w, self.model.scores)
            self.known[w] = self._ids([self.model.ids.get(p, -ord(p[0]) - 2) for p in parts])
        portion = np.cumsum([len(w) for w in plain], dtype=np.int64) // INDEX_CHARS
        cuts = [*np.unique(portion, return_index=True)[1].tolist(), len(plain)]
        for a, b in pairwise(cuts):
            tokens, sizes = self._relax(plain[a:b])
            ends = np.cumsum(sizes)
            flat = tokens.astype(np.int32).tobytes()
            odd = set(np.searchsorted(ends, np.flatnonzero(tokens < 0), side="right").tolist())
            begin = 0
            for i, (w, end) in enumerate(zip(plain[a:b], ends.tolist())):
                self.known[w] = self._ids(tokens[begin:end].tolist()) if i in odd else flat[4 * begin : 4 * end]
                begin = end

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [WORDS.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        words = set().union(*split)
        new = words.difference(self.known)
        if len(self.known) + len(new) > KNOWN_WORDS:  # words not seen since the last time go
            self.known, self.older = {}, self.known
            new = words
        again = {w: self.older[w] for w in new if w in self.older}
        self.known.update(again)
        self._learn(list(new.difference(again)))
        pieces_of = self.known.__getitem__
        return [np.frombuffer(b"".join(map(pieces_of, words)), dtype=np.int32) for words in split]


def merge_long(text: str, scores: dict[str, float]) -> list[str]:
    """merge() for long words, with a heap of neighbours instead of a scan for each merge."""
    import heapq

    parts: list[str | None] = list(text)
    right, left = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, str]] = []

    def offer(i):
        if i >= 0 and right[i] < len(parts):
            both = parts[i] + parts[right[i]]
            if both in scores:
                heapq.heappush(heap, (-scores[both], i, both))

    for i in range(len(parts)):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        if parts[i] is None or right[i] >= len(parts) or parts[i] + parts[right[i]] != both:
            continue
        j = right[i]
        parts[i], parts[j], right[i] = both, None, right[j]
        if right[i] < len(parts):
            left[right[i]] = i
        offer(left[i])
        offer(i)
    return [p for p in parts if p is not None]


class Decoder:
    def __init__(self, model: PieceModel):
        self.bytes = [p.replace(SPACE, " ").encode() for p in model.pieces]
        for b, i in enumerate(model.byte_ids):
            self.bytes[i] = bytes([b])

    def decode(self, ids: np.ndarray) -> str:
        known = self.bytes
        return b"".join([known[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())]
)
TOKENS_DDL = "doc_id long, n_tokens long, ids array<int>, round_trip boolean"


def encode(docs: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, round_trip) of every row and whole text.

    round_trip says that decoding gives the text again; only a text that holds U+2581 itself, which the encoding shares
    with the blank, does not. Null and empty texts have no tokens. Rows that repeat are encoded row by row; other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(*shared.value)
        encoder, decoder = Encoder(model), Decoder(model)

        def out(ids, texts):
            tokens = encoder.encode(texts)
            same = [decoder.decode(t) == text for t, text in zip(tokens, texts)]
            sizes = np.array([len(t) for t in tokens], dtype=np.int64)
            flat = np.concatenate([np.zeros(0, np.int32), *tokens])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes), lists, pa.array(same)], schema=TOKENS
            )

        for batch in batches:
            for ids, texts in portions(batch, BATCH_CHARS):
                yield out(ids, texts)
        batch = None
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, TOKENS_DDL)


def decode(tokens: DataFrame, model: PieceModel, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every row of piece ids; null ids give an empty text."""
    shared = tokens.sparkSession.sparkContext.broadcast(model.plain())
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(PieceModel(*shared.value))
        rows = (
            (i, decoder.decode(np.array(t or [], dtype=np.int32)))
            for batch in batches for i, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids")))
        )
        yield from record_batches(rows, schema)

    rows = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def op9_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), PieceModel.load())
