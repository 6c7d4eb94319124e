"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a state machine over bytes.

Merging acts from the end of what has been read at a bounded distance only: see Merges.lookahead. So the tokens that end
further back than that stay as they are whatever follows, and are emitted. The transducer keeps the symbols after
the last emitted token, whose number is bounded by the merge list and not by the text.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.shelf import portions, table, text_or_empty

MODEL = "word_bpe_49k.json"  # below the folder of the public tokenizers
BATCH_CHARS = 1_000_000  # text that is encoded together
KNOWN_WORDS = 200_000  # short words in each of the two generations that a task remembers
FEW = 24  # up to so many symbols, all pairs are looked at for each merge; words of so many bytes are remembered
STEP = 256  # symbols that a full transducer takes before it looks for stable tokens
MAX_MERGES = 1_000_000  # the merge list is broadcast: refuse what is larger
ID_BITS = 21  # of a token's id in the key of a pair

# What the model's file must say of normalisation, word splitting and decoding to be supported.
NORMALIZERS = [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_MODEL = {
    "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False,
    "byte_fallback": False, "ignore_merges": False,
}
# White space; letters and numbers, and capital letters with their small ones, that the library knows besides
# those of Unicode 15.1.
WHITE = r"\t-\r \x85\xa0  -     　"

NEW_LETTERS = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7 "
    "113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0"
)
NEW_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
NEW_SMALL = (
    "1C89>1C8A A7CB>264 A7CC>A7CD A7CE>A7CF A7D2>A7D3 A7D4>A7D5 A7DA>A7DB A7DC>19B 10D50-10D65>10D70 16EA0-16EB8>16EBB"
)


def _spans(kind: str, more: str) -> list[tuple[int, int]]:
    """Ranges of the code points of a general category, and more."""
    out: list[list[int]] = []
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == kind:
            if out and out[-1][1] == c - 1:
                out[-1][1] = c
            else:
                out.append([c, c])
    for span in more.split():
        begin, _, end = span.partition("-")
        out.append([int(begin, 16), int(end or begin, 16)])
    return [(a, b) for a, b in out]


def word_pattern(top: int = 0x110000) -> str:
    """SPLIT with its classes of characters below `top` written out, so that every task splits words alike.

    The endings after an apostrophe come later than in SPLIT, which is the same, as no word or number starts with one.
    """
    letters, numbers = (
        "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in _spans(kind, more) if a < top)
        for kind, more in (("L", NEW_LETTERS), ("N", NEW_NUMBERS))
    )
    return rf"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^{WHITE}{letters}{numbers}]+"


def _new_small() -> dict[int, int]:
    out = {}
    for entry in NEW_SMALL.split():
        span, _, small = entry.partition(">")
        begin, _, end = span.partition("-")
        for c in range(int(begin, 16), int(end or begin, 16) + 1):
            out[c] = int(small, 16) + c - int(begin, 16)
    return out


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is one, else one after U+00FF in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


@dataclass(frozen=True)
class Merges:
    """The merge list of a model of words: ranks of pairs, ids of tokens, and its strings that stand for one id."""

    ids: dict[str, int]
    pairs: list[tuple[str, str]]
    word_end: str
    special: dict[str, int]
    lookahead: int | None = None  # computed here if not given, as is the next
    longest: int | None = None  # symbols of the longest token
    ranks: dict[tuple[str, str], int] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "ranks", {p: r for r, p in enumerate(self.pairs)})
        if self.lookahead is None or self.longest is None:
            widths, lookahead = self._analyse()
            object.__setattr__(self, "longest", max(widths.values(), default=1))
            object.__setattr__(self, "lookahead", lookahead)

    def _analyse(self) -> tuple[dict[str, int], int]:
        """Symbols of each token, and how far from the end of what is read tokens can still change.

        Compare one text with two continuations, rank by rank. Up to some place both have the same tokens; a merge of
        (left, right) moves that place back by `left` if the last common token is its left part. The token at the
        place then grew from the left part of the merge that moved it before. So the places lost belong to a
        chain of merges of rising rank where each right part starts with the left part before it, as itself or as the
        first part of its first part and so on; the longest chain, weighed by the left parts, bounds the loss.
        It needs a list in which a merge comes after those that make its parts.
        """
        width: dict[str, int] = {}
        first: dict[str, str] = {}  # first part of a token
        reach: dict[str, int] = {}  # of the chains that end with a merge of this left part
        bound = 0
        for left, right in self.pairs:
            both = left + right
            if both in first or any(len(p) > 1 and p not in first and not self._single(p) for p in (left, right)):
                raise ValueError("the merges are not in an order in which their parts come first")
            width[both] = sum(width.get(p, 1) for p in (left, right))
            first[both] = left
            before, part = 0, right
            while part is not None:
                before, part = max(before, reach.get(part, 0)), first.get(part)
            chain = before + width.get(left, 1)
            reach[left] = max(reach.get(left, 0), chain)
            bound = max(bound, chain)
        return width, bound

    def _single(self, token: str) -> bool:
        return bool(self.word_end) and token.endswith(self.word_end) and len(token) == 1 + len(self.word_end)

    def merge(self, symbols: list[str]) -> list[str]:
        """The tokens of these symbols: the pair of the lowest rank is merged, the first of equals, until none is left."""
        if len(symbols) > FEW:
            return self._merge_many(symbols)
        rank_of, parts = self.ranks.get, list(symbols)
        ranks = [rank_of(pair, MAX_MERGES) for pair in zip(parts, parts[1:])]
        while ranks:
            rank = min(ranks)
            if rank == MAX_MERGES:
                break
            at = ranks.index(rank)
            parts[at] += parts.pop(at + 1)
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((parts[at - 1], parts[at]), MAX_MERGES)
            if at < len(ranks):
                ranks[at] = rank_of((parts[at], parts[at + 1]), MAX_MERGES)
        return parts

    def _merge_many(self, symbols: list[str]) -> list[str]:
        """The same with a heap of pairs."""
        parts: list[str | None] = list(symbols)
        right, left = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        ranks, heap = self.ranks, []
        for i in range(len(parts) - 1):
            rank = ranks.get((parts[i], parts[i + 1]))
            if rank is not None:
                heap.append((rank, i))
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = right[i]
            if parts[i] is None or j >= len(parts) or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i], parts[j], right[i] = parts[i] + parts[j], None, right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            for at in (left[i], i):
                if at >= 0 and right[at] < len(parts):
                    rank = ranks.get((parts[at], parts[right[at]]))
                    if rank is not None:
                        heapq.heappush(heap, (rank, at))
        return [p for p in parts if p is not None]

    def plain(self) -> tuple:
        return self.ids, self.pairs, self.word_end, self.special, self.lookahead, self.longest

    @staticmethod
    def load(path: str | None = None) -> Merges:
        """The model of a tokenizer file; only lower-case models of words over bytes, as MODEL is, are supported."""
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(MODEL)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, splitter = file["model"], file["pre_tokenizer"]["pretokenizers"]
        if (
            file["normalizer"].get("normalizers") != NORMALIZERS or file["decoder"] is not None
            or any(model[k] != v for k, v in PLAIN_MODEL.items()) or len(splitter) != 2
            or splitter[0] != {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
            or splitter[1]["type"] != "ByteLevel" or splitter[1]["add_prefix_space"] or splitter[1]["use_regex"]
            or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"])
        ):
            raise ValueError("only lower-case models of words over bytes are supported")
        if len(model["merges"]) > MAX_MERGES:
            raise ValueError("the merge list is too large to broadcast")
        pairs = [tuple(p.split(" ") if isinstance(p, str) else p) for p in model["merges"]]
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        return Merges(model["vocab"], pairs, model["end_of_word_suffix"] or "", special)


class Transducer:
    """Takes the symbols of one word in any portions and emits its tokens as soon as nothing can change them."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.held: list[str] = []
        # With so many symbols the first token at least is out of reach of what follows.
        self.full = merges.lookahead + merges.longest + 1

    def feed(self, symbols: str) -> list[str]:
        out = []
        for begin in range(0, len(symbols), STEP):
            self.held += symbols[begin : begin + STEP]
            if len(self.held) < self.full + STEP:
                continue
            # The last symbol may become the end of the word; it counts among what follows.
            stable = len(self.held) - 1 - self.merges.lookahead
            end = 0
            for token in self.merges.merge(self.held[:-1]):
                if end + len(token) > stable:  # no token of inner symbols holds the mark of the end
                    break
                end += len(token)
                out.append(token)
            del self.held[:end]
        return out

    def finish(self) -> list[str]:
        if self.held:
            self.held[-1] += self.merges.word_end
        out, self.held = self.merges.merge(self.held), []
        return out


class Encoder:
    """Token ids of whole texts; remembers the ids of short words up to a bound."""

    def __init__(self, merges: Merges, patterns: tuple[str, str] | None = None):
        self.merges = merges
        # Classes of characters below U+10000 alone are looked up much faster.
        few, all_ = patterns or (word_pattern(0x10000), word_pattern())
        self.words, self.all_words = re.compile(few).findall, re.compile(all_).findall
        self.beyond = re.compile("[\U00010000-\U0010FFFF]").search
        self.special = re.compile("|".join(map(re.escape, sorted(merges.special, key=len, reverse=True))) or r"(?!)")
        self.new_small = _new_small()
        self.any_new = re.compile("[" + "".join(map(chr, self.new_small)) + "]").search
        self.symbols = byte_symbols()
        # The same list by ids, for words that fit into one portion: first symbols, ranks of pairs, what a merge gives.
        ids, end = merges.ids, merges.word_end
        self.inner, self.last = (np.array([ids[s + e] for s in self.symbols], dtype=np.int64) for e in ("", end))
        pairs = np.array([ids[a] << ID_BITS | ids[b] for a, b in merges.pairs], dtype=np.int64)
        self.rank_order = np.argsort(pairs)
        self.sorted_pairs = np.append(pairs[self.rank_order], np.iinfo(np.int64).max)
        self.rank_order = np.append(self.rank_order, MAX_MERGES)
        self.made = np.array([ids[a + b] for a, b in merges.pairs], dtype=np.int64)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << ID_BITS | right
        at = np.searchsorted(self.sorted_pairs, pair)
        return np.where(self.sorted_pairs[at] == pair, self.rank_order[at], MAX_MERGES)

    def _merge_all(self, raws: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """Merges.merge() on ids for words of one number of bytes, one merge a round in all that still have one.

        Gives the place of each word and its ids.
        """
        code = np.frombuffer(b"".join(raws), dtype=np.uint8).reshape(len(raws), -1)
        parts = self.inner[code]
        parts[:, -1] = self.last[code[:, -1]]
        place = np.arange(len(raws))
        ranks = self._ranks(parts[:, :-1], parts[:, 1:])
        while len(place):
            if parts.shape[1] > 1:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(at)), at]
                more = best < MAX_MERGES
            else:
                more = np.zeros(len(place), dtype=bool)
            done = parts[~more].astype(np.int32)
            yield from zip(place[~more].tolist(), (row.tobytes() for row in done))
            parts, ranks, place = parts[more], ranks[more], place[more]
            if not len(place):
                return
            at, best, every = at[more], best[more], np.arange(len(place))
            parts[every, at] = self.made[best]
            column = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, column + (column > at[:, None]), axis=1)
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side < ranks.shape[1]))
                where = side[ok]
                ranks[ok, where] = self._ranks(parts[ok, where], parts[ok, where + 1])

    def _learn(self, words: set[str]) -> list[str]:
        """Know the ids of all these words. Returns those that are too long to be remembered after the batch."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > KNOWN_WORDS:  # words not seen since the last time go
            self.known, self.older = {}, self.known
            new = words
        again = {w: self.older[w] for w in new if w in self.older}
        self.known.update(again)
        by_size: dict[int, tuple[list[str], list[bytes]]] = {}
        long = []
        for word in new.difference(again):
            raw = word.encode()
            if len(raw) > FEW:
                long.append(word)
                self.known[word] = self.word_ids(word)
                continue
            own, raws = by_size.setdefault(len(raw), ([], []))
            own.append(word)
            raws.append(raw)
        for own, raws in by_size.values():
            for i, out in self._merge_all(raws):
                self.known[own[i]] = out
        return long

    def word_ids(self, word: str) -> bytes:
        raw = word.encode()
        machine = Transducer(self.merges)
        tokens = machine.feed("".join([self.symbols[b] for b in raw]))
        tokens += machine.finish()
        return array("i", [self.merges.ids[t] for t in tokens]).tobytes()

    def _words(self, text: str) -> list[str]:
        split = self.words
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if self.any_new(text):
                text = text.translate(self.new_small)
            if self.beyond(text):
                split = self.all_words
        # Characters become lower case one by one: a sigma at the end of a word is one like others.
        return split(text.replace("Σ", "σ").lower())

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, 4 bytes each. The strings of special tokens are these tokens, wherever they stand."""
        parts: list[list] = []
        for text in texts:
            own, begin = [], 0
            for m in self.special.finditer(text) if any(s in text for s in self.merges.special) else ():
                own += [self._words(text[begin : m.start()]), np.int32(self.merges.special[m.group()]).tobytes()]
                begin = m.end()
            parts.append([*own, self._words(text[begin:] if begin else text)])
        long = self._learn(set().union(*(p for own in parts for p in own if isinstance(p, list))))
        ids_of = self.known.__getitem__
        out = [b"".join([p if isinstance(p, bytes) else b"".join(map(ids_of, p)) for p in own]) for own in parts]
        for word in long:
            del self.known[word]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


class Decoder:
    """Ids to text, one after the other: each gives bytes, and bytes give characters once these are complete.

    `spelled` gives the tokens' own strings, a blank between them, as the library does for a model without a decoder. Otherwise the
    bytes that the tokens stand for, with a blank after each word; bytes that are no UTF-8 become U+FFFD.
    """

    def __init__(self, merges: Merges, spelled: bool):
        byte = {s: b for b, s in enumerate(byte_symbols())}
        self.spelled = spelled
        self.bytes: dict[int, bytes] = {i: s.encode() for s, i in merges.special.items()}
        for token, i in merges.ids.items():
            if spelled:
                self.bytes.setdefault(i, token.encode())
                continue
            inner, end = (token[: -len(merges.word_end)], b" ") if token.endswith(merges.word_end) else (token, b"")
            self.bytes.setdefault(i, bytes(byte[c] for c in inner) + end)

    def stream(self, ids: Iterator[int]) -> Iterator[str]:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        gap = b""
        for i in ids:
            yield machine.decode(gap + self.bytes[i])
            gap = b" " if self.spelled else b""
        yield machine.decode(b"", True)

    def decode(self, ids: list[int]) -> str:
        """What stream() gives, with the bytes of all ids fed at once."""
        known = self.bytes
        joined = (b" " if self.spelled else b"").join([known[i] for i in ids])
        return codecs.getincrementaldecoder("utf-8")("replace").decode(joined, True)


def encode(docs: DataFrame, merges: Merges, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row and whole text.

    Null and empty texts, and those of white space only, have no ids. Rows that repeat or have no id are encoded row by
    row; other columns are not read. Words of any length take memory for their symbols but none for their merges.
    """
    shared = docs.sparkSession.sparkContext.broadcast((merges.plain(), (word_pattern(0x10000), word_pattern())))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        plain, patterns = shared.value
        encoder = Encoder(Merges(*plain), patterns)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

        def out(ids, texts):
            tokens = encoder.encode_all(texts)
            offsets = np.concatenate([[0], np.cumsum([len(t) // 4 for t in tokens])]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(tokens), dtype=np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets), flat)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], schema=schema)

        for batch in batches:
            for ids, texts in portions(batch, BATCH_CHARS):
                yield out(ids, texts)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(
    tokens: DataFrame, merges: Merges, spelled: bool = False, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """(doc_id, ids, text) of every row of ids; null ids give an empty text. For `spelled` see Decoder."""
    # Decoding needs no merges.
    ids, _, *rest = merges.plain()
    shared = tokens.sparkSession.sparkContext.broadcast((ids, [], *rest))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        decoder = Decoder(Merges(*shared.value), spelled)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])
        for batch in batches:
            begin, size = 0, 0
            for i, n in enumerate(batch.column("ids").value_lengths().to_pylist()):
                size += n or 0
                if size > BATCH_CHARS or i + 1 == batch.num_rows:
                    part = batch.slice(begin, i + 1 - begin)
                    # Lists by their ends in the flat column: much faster than as Python lists at once.
                    lists = part.column("ids").fill_null(pa.scalar([], pa.list_(pa.int32())))
                    flat, ends = lists.flatten().tolist(), lists.value_lengths().to_numpy().cumsum().tolist()
                    texts = [decoder.decode(flat[a:b]) for a, b in zip([0, *ends], ends)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], schema=schema
                    )
                    begin, size = i + 1, 0

    rows = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, text string")


def op12_bounded_lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    merges = Merges.load()
    tokens = decode(encode(table(spark, sf_dir, "documents"), merges), merges, spelled=True)
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
