"""Problem 8: token ids of whole texts by a public byte-level BPE vocabulary.

Method: texts are cut into words by the vocabulary's pattern; the distinct words of a batch become length-bucketed,
padded numpy matrices of byte ids. Each round, every row merges its leftmost pair of minimum rank, found through a
hashed lookup of pairs, and the rows are compacted; rows without a pair to merge are done. Words longer than the widest
bucket are merged by themselves, all occurrences of the minimum pair at once (a merge can only make pairs of later rank).
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrand.session import ship

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: the pattern that cuts a text into words, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BUCKETS = (4, 6, 8, 10, 12, 16, 24, 32, 64)
MEMO = 300_000  # distinct words whose ids a worker keeps; a cache only
NONE = np.int64(1) << 40


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such vocabularies: printable ones for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pairs:
    """Hashed lookup of pairs: open addressing in a table of twice the size, probed for whole arrays at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(left) - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NONE, np.int64)
        self.merged = np.zeros(1 << self.bits, np.int32)
        self.probes = 1
        mask = (1 << self.bits) - 1
        for k, h, r, m in zip((k := self.key(left, right)).tolist(), self.hash(k).tolist(), rank.tolist(), merged.tolist(), strict=True):
            n = 1
            while self.keys[h] >= 0:
                h, n = (h + 1) & mask, n + 1
            self.keys[h], self.rank[h], self.merged[h] = k, r, m
            self.probes = max(self.probes, n)

    @staticmethod
    def key(left, right):
        return left.astype(np.int64) << 20 | right.astype(np.int64)

    def hash(self, k):
        with np.errstate(over="ignore"):
            return ((k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left, right) -> np.ndarray:
        """The slot of each pair, -1 where there is none or a side is padding (-1)."""
        k = np.where((left < 0) | (right < 0), -2, self.key(left, right))
        at = self.hash(k)
        slot = np.where(self.keys[at] == k, at, -1)
        todo = np.flatnonzero((slot.ravel() < 0) & (k.ravel() >= 0) & (self.keys[at].ravel() >= 0))
        flat, fk, fa = slot.ravel(), k.ravel(), at.ravel()
        mask = (1 << self.bits) - 1
        for step in range(1, self.probes):
            if not len(todo):
                break
            a = (fa[todo] + step) & mask
            there = self.keys[a]
            hit = there == fk[todo]
            flat[todo[hit]] = a[hit]
            todo = todo[~hit & (there >= 0)]
        return flat.reshape(k.shape)


class Bpe:
    """A byte-level BPE vocabulary, given as the text of its JSON file."""

    def __init__(self, source: str) -> None:
        model = json.loads(source)["model"]
        vocab, letters = model["vocab"], byte_letters()
        self.byte_ids = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        arr = lambda x: np.array(x, np.int64)
        self.pairs = Pairs(arr([vocab[a] for a, _ in merges]), arr([vocab[b] for _, b in merges]), np.arange(len(merges)), arr([vocab[a + b] for a, b in merges]))
        self.word = regex.compile(PATTERN)
        self.memo: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.memo.clear()
        self.starts = np.zeros(1, np.int64)  # ids of word i: ids[starts[i]:starts[i + 1]]
        self.ids = np.zeros(0, np.int32)

    def merge_rows(self, m: np.ndarray) -> list[np.ndarray]:
        """Merge the rows of a padded matrix (padding -1 at the end) until none has a pair left."""
        n = len(m)
        out: list = [None] * n
        rows = np.arange(n)
        while len(rows):
            if m.shape[1] < 2:
                slot = np.full((len(m), 1), -1)
            else:
                slot = self.pairs.find(m[:, :-1], m[:, 1:])
            rank = np.where(slot >= 0, self.pairs.rank[slot], NONE)
            at = rank.argmin(1)  # the leftmost of minimum rank
            here = np.arange(len(m))
            more = rank[here, at] < NONE
            for i in np.flatnonzero(~more):
                out[rows[i]] = m[i][m[i] >= 0]
            m, rows, at, slot = m[more], rows[more], at[more], slot[more]
            if not len(rows):
                break
            here = np.arange(len(m))
            m[here, at] = self.pairs.merged[slot[here, at]]
            # Compaction: what stands right of the merged pair moves one place left.
            col = np.arange(m.shape[1] - 1)
            m = np.where(col[None, :] <= at[:, None], m[:, :-1], m[:, 1:])
        return out

    def merge_long(self, row: np.ndarray) -> np.ndarray:
        """One word of any length."""
        while len(row) > 1:
            slot = self.pairs.find(row[:-1], row[1:])
            rank = np.where(slot >= 0, self.pairs.rank[slot], NONE)
            if (best := rank.min()) >= NONE:
                break
            hits = np.flatnonzero(rank == best)
            if len(hits) > 1:  # of overlapping occurrences the leftmost wins: every other one within a run
                run = np.concatenate([[True], np.diff(hits) != 1])
                first = np.maximum.accumulate(np.where(run, np.arange(len(hits)), 0))
                hits = hits[(np.arange(len(hits)) - first) % 2 == 0]
            row = row.copy()
            row[hits] = self.pairs.merged[slot[hits[0]]]
            row = np.delete(row, hits + 1)
        return row

    def learn(self, words: list[str]) -> None:
        """Encode words that the memo does not hold yet."""
        raw = [w.encode("utf-8", "replace") for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        done: list = [None] * len(raw)
        low = 0
        for high in BUCKETS:
            sel = np.flatnonzero((lengths > low) & (lengths <= high))
            low = high
            if len(sel):
                m = np.full((len(sel), high), -1, np.int32)
                flat = np.frombuffer(b"".join(raw[i] for i in sel), np.uint8)
                n = lengths[sel]
                r = np.repeat(np.arange(len(sel)), n)
                m[r, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = self.byte_ids[flat]
                for i, x in zip(sel, self.merge_rows(m), strict=True):
                    done[i] = x
        for i in np.flatnonzero(lengths > BUCKETS[-1]):
            done[i] = self.merge_long(self.byte_ids[np.frombuffer(raw[i], np.uint8)])
        base = len(self.starts) - 1
        self.memo.update(zip(words, range(base, base + len(words)), strict=True))
        sizes = np.fromiter(map(len, done), np.int64, len(done))
        self.ids = np.concatenate([self.ids, *done])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]; NULL and empty texts have none."""
        if len(self.memo) > MEMO:
            self._clear()
        cut = [self.word.findall(t) if t else [] for t in texts]
        new = {w for ws in cut for w in ws if w not in self.memo}
        if new:
            self.learn(list(new))
        memo = self.memo
        which = np.fromiter((memo[w] for ws in cut for w in ws), np.int64)
        sizes = self.starts[which + 1] - self.starts[which]
        total = int(sizes.sum())
        before = np.cumsum(sizes) - sizes
        ids = self.ids[np.arange(total) - np.repeat(before, sizes) + np.repeat(self.starts[which], sizes)] if total else np.zeros(0, np.int32)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        words = np.concatenate([[0], np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))])
        return ends[words], ids


def _source(vocabulary: str) -> str:
    with open(vocabulary, encoding="utf-8") as f:
        return f.read()


_held: dict[str, Bpe] = {}  # one vocabulary for each worker process


def bpe_of(source: str) -> Bpe:
    if source not in _held:
        _held.clear()
        _held[source] = Bpe(source)
    return _held[source]


def _map(df: DataFrame, doc: str, text: str, vocabulary: str, make, schema: str, keep: str | None = None) -> DataFrame:
    ship(df.sparkSession)
    source = df.sparkSession.sparkContext.broadcast(_source(vocabulary))  # one file of 1.5 MB, whatever the corpus

    def run(batches):
        bpe = bpe_of(source.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # bounds what a batch of long texts needs at a time
                part = batch.slice(at, 512)
                yield make(part, *bpe.encode(part.column(1).to_pylist()))

    more = [F.col(keep).cast("string").alias("kept")] if keep else []
    return df.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *more).mapInArrow(run, schema)


def token_ids(documents: DataFrame, *, doc: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids): every row, its token ids without special tokens. NULL and empty texts give an empty list.

    Whole texts, in one pass without a shuffle. Strings of special tokens are ordinary text. Repeated ids give a row
    each; other columns are ignored.
    """
    def make(part, offsets, ids):
        return pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    return _map(documents, doc, text, vocabulary, make, "doc_id bigint, ids array<int>")


def token_counts(documents: DataFrame, *, doc: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, keep: str | None = None) -> DataFrame:
    """(doc_id, tokens): the number of token ids of every row; 0 for NULL and empty texts. keep: a column kept as a string."""
    def make(part, offsets, ids):
        n = pa.array(np.diff(offsets), pa.int64())
        return pa.RecordBatch.from_arrays([part.column(0), *([part.column(2)] if keep else []), n], ["doc_id", *([keep] if keep else []), "tokens"])

    return _map(documents, doc, text, vocabulary, make, f"doc_id bigint, {f'`{keep}` string, ' if keep else ''}tokens bigint", keep)
