"""Byte-level BPE with forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be joined by merges, as every
product of a merge is a token. Each such pair marks a certain cut. A text is cut into
pre-tokens (the tokenizer's own word pattern), these at the certain cuts, and the
fragments are encoded independently, each once a task while it stays in a bounded
memory of recent ones; the ids are concatenated.

Strings of the file's added tokens (``<|endoftext|>``) become that token's id, as the
tokenizers library does by default. Decoding joins the tokens' bytes and reads them as
UTF-8 with replacement marks.

Edge cases: empty or missing text: no ids, empty decoded text. A very long word costs
n log n through a heap of merges. Repeated rows give equal results. Empty input: empty.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import partial
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_of

#: pre-token pattern of byte-level BPE files that say ``use_regex`` (fixed values)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: fragments remembered in a task, and the longest one that is
REMEMBERED, LONGEST = 500_000, 64
#: bytes of a fragment whose pairs are scanned for each merge
SHORT = 24


def byte_alphabet() -> dict[int, str]:
    """Byte-level files write each byte as one printable character: printable Latin-1
    bytes as themselves, the others as U+0100 onwards in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ForcedBoundaryBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        back = {c: b for b, c in letters.items()}

        def raw(token: str) -> bytes:
            return bytes(back[c] for c in token)

        model = spec["model"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.added}
        self.bytes_of = {i: raw(t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.added.items()}
        ids = {raw(t): i for t, i in vocab.items()}
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.rank = {pair: rank for pair, (rank, _) in self.merges.items()}
        self.product = [joined for _, joined in self.merges.values()]
        inside = {t[i:i + 2] for t in self.bytes_of.values() for i in range(len(t) - 1)}
        self.inside = inside
        self.words = regex.compile(PATTERN)
        self.split_added = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.seen: dict[str, tuple[int, ...]] = {}

    def fragments(self, data: bytes) -> list[bytes]:
        """``data`` cut at every byte pair that no token contains."""
        inside, at, out = self.inside, 0, []
        for i in range(1, len(data)):
            if data[i - 1:i + 1] not in inside:
                out.append(data[at:i])
                at = i
        out.append(data[at:])
        return out

    def merge(self, fragment: bytes) -> list[int]:
        """Merge by rank, leftmost first: by scanning a short fragment, in a long one by a
        heap over a linked list of parts."""
        ids = [self.byte_id[b] for b in fragment]
        if len(ids) <= SHORT:
            rank, none, product = self.rank.get, len(self.product), self.product
            ranks = [rank(pair, none) for pair in zip(ids, ids[1:])]  # noqa: B905
            while ranks and (best := min(ranks)) != none:
                i = ranks.index(best)
                ids[i] = joined = product[best]
                del ids[i + 1], ranks[i]
                if i:
                    ranks[i - 1] = rank((ids[i - 1], joined), none)
                if i < len(ranks):
                    ranks[i] = rank((joined, ids[i + 1]), none)
            return ids
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, joined = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the parts has been merged meanwhile
            ids[i], ids[j] = joined, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((joined, ids[k])):
                    heapq.heappush(heap, (m[0], i, joined, ids[k], m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], joined))):
                heapq.heappush(heap, (m[0], h, ids[h], joined, m[1]))
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> tuple[int, ...]:
        got = tuple(chain.from_iterable(map(self.merge, self.fragments(word.encode("utf-8")))))
        if len(word) <= LONGEST:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[word] = got
        return got

    def encode(self, text: str) -> list[int]:
        if self.split_added is None:
            return self._plain(text)
        out: list[int] = []
        for i, part in enumerate(self.split_added.split(text)):
            if i % 2:
                out.append(self.added[part])
            elif part:
                out += self._plain(part)
        return out

    def _plain(self, text: str) -> list[int]:
        words = self.words.findall(text)
        known = self.seen
        for w in set(words).difference(known):
            if len(w) <= LONGEST:
                self.word(w)
        try:
            return list(chain.from_iterable(map(known.__getitem__, words)))
        except KeyError:  # a long word, or the memory was emptied meanwhile
            return list(chain.from_iterable(known[w] if w in known else self.word(w) for w in words))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = ForcedBoundaryBPE(path)
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([bpe.encode(t.as_py()) for t in b.column(1)], pa.list_(pa.int32()))], names=["doc_id", "ids"])


def _digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = ForcedBoundaryBPE(path)
    name = [str(i) for i in range(max(bpe.bytes_of) + 1)]
    for b in batches:
        n, ids_sha, text_sha = [], [], []
        for t in b.column(1):
            ids = bpe.encode(t.as_py())
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join([name[i] for i in ids]).encode()).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                                         names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row."""
    return _rows(docs, id_col, text_col).mapInArrow(partial(_encoded, path=path), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded from the ids.
    Digests are taken beside the encoder, so no id list is moved."""
    return _rows(docs, id_col, text_col).mapInArrow(
        partial(_digests, path=path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


ship(__name__)
