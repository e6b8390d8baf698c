"""Byte-level BPE over a whole corpus by merge replay.

A task takes its share of the corpus in Arrow blocks. Texts are cut at single spaces by the
C++ kernels of Arrow, the pieces are dictionary-encoded, and only pieces never seen by the
worker reach Python: they are split into pre-tokens by the public pattern, and all new
pre-tokens of the block are encoded together by replaying the merge list in rank order. An
inverted index from token pair to positions names the places a merge touches, and each merge
updates only the two neighbours of a place. The ids of the texts are then gathered with
numpy. There is no shuffle, and nothing is sent to the driver.

Defined results: a null text and an empty text both give an empty list. Strings that look like
control tokens are ordinary text. Lone surrogates cannot occur (Spark strings are UTF-8).
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Text of a block that is encoded at once; bounds the memory of a worker, not the result.
BLOCK_BYTES = 8 << 20
#: Known pieces kept by a worker; beyond it the memory is emptied, the result stays the same.
CACHE_PIECES = 400_000


def default_vocabulary() -> str:
    """Place of the public vocabulary ``byte_bpe_50k`` on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, n = {b: chr(b) for b in keep}, 0
    for b in range(256):
        if b not in letters:
            letters[b], n = chr(256 + n), n + 1
    return [letters[b] for b in range(256)]


class MergeReplay:
    """Encode sets of words by replaying all merges over them in rank order."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        letters = byte_letters()
        self.byte_id = [vocab[c] for c in letters]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank.setdefault((vocab[a], vocab[b]), (r, vocab[a + b]))

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word; words do not influence each other."""
        byte_id, rank = self.byte_id, self.rank
        token: list[int] = []
        starts: list[int] = []
        for w in words:
            starts.append(len(token))
            token.extend(byte_id[b] for b in w)
            token.append(-1)  # no merge crosses it
        n = len(token)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        index: dict[tuple[int, int], list[int]] = {}
        for i in range(n - 1):
            p = (token[i], token[i + 1])
            if p in rank:
                index.setdefault(p, []).append(i)
        heap = [(*rank[p], p) for p in index]
        heapq.heapify(heap)
        while heap:
            _, merged, pair = heapq.heappop(heap)
            a, b = pair
            places = index.pop(pair, None)
            if not places:
                continue
            places.sort()  # in runs such as aaa the leftmost pair merges
            for i in places:
                j = after[i]
                if token[i] != a or j >= n or token[j] != b:
                    continue  # a neighbour's merge took it
                k = after[j]
                token[i], token[j], after[i] = merged, -2, k
                if k < n:
                    before[k] = i
                    if (p := (merged, token[k])) in rank:
                        if p not in index:
                            index[p] = []
                            heapq.heappush(heap, (*rank[p], p))
                        index[p].append(i)
                h = before[i]
                if h >= 0 and (p := (token[h], merged)) in rank:
                    if p not in index:
                        index[p] = []
                        heapq.heappush(heap, (*rank[p], p))
                    index[p].append(h)
        out = []
        for s, w in zip(starts, words):
            ids, i = [], s
            while token[i] >= 0:
                ids.append(token[i])
                i = after[i]
            out.append(ids)
        return out


class BlockEncoder:
    """Ids of blocks of texts; keeps what it has learnt between blocks."""

    def __init__(self, vocabulary: str):
        import regex

        self.replay = MergeReplay(vocabulary)
        self.pre = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
        self.words: dict[str, list[int]] = {}
        self.pieces: dict[str, np.ndarray] = {}

    def piece_ids(self, pieces: list[str]) -> list[np.ndarray]:
        known = self.pieces
        if len(known) > CACHE_PIECES:
            known.clear()
            self.words.clear()
        new = {p: self.pre(p) for p in pieces if p not in known}
        if new:
            words = self.words
            missing = sorted({w for ws in new.values() for w in ws if w not in words})
            words.update(zip(missing, self.replay.encode([w.encode("utf-8") for w in missing])))
            for p, ws in new.items():
                known[p] = np.array([i for w in ws for i in words[w]], dtype=np.int32)
        return [known[p] for p in pieces]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts; null counts as empty.

        A pre-token starts at every space that precedes a non-space, so a text may be cut
        there. Pieces that are empty or start with white space stay joined to the one before.
        """
        texts = pc.fill_null(texts.cast(pa.string()), "")
        split = pc.split_pattern(texts, " ")
        offsets, flat = split.offsets.to_numpy(), split.flatten()
        first = np.zeros(len(flat), dtype=bool)
        first[offsets[:-1]] = True
        glued = pc.match_substring_regex(flat, f"^(?:$|[{_space_re2()}])").to_numpy(zero_copy_only=False)
        glued &= ~first
        # a unit is (has a leading space, text)
        head = np.flatnonzero(~glued)
        if len(head) != len(flat):
            lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(flat)), pa.int32()), flat)
            flat = pc.binary_join(lists, " ")
        led = ~first[head]
        enc = pc.dictionary_encode(flat)
        if isinstance(enc, pa.ChunkedArray):
            enc = enc.combine_chunks()
        names, idx = enc.dictionary.to_pylist(), enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # first pieces of texts have no leading space: they get codes of their own
        code = idx * 2 + led
        used = np.flatnonzero(np.bincount(code, minlength=2 * len(names) + 2))
        to = np.zeros(2 * len(names) + 2, dtype=np.int64)
        to[used] = np.arange(len(used))
        code = to[code]
        ids = self.piece_ids([(" " if u & 1 else "") + names[u >> 1] for u in used.tolist()])
        lens = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        pool = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        begin = np.cumsum(lens) - lens
        n = lens[code]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        out = pool[np.repeat(begin[code] - (ends - n), n) + np.arange(total)]
        # texts start at their first piece
        text_of = np.searchsorted(head, offsets[:-1])
        bounds = np.append((ends - n)[text_of], total) if len(offsets) > 1 else np.zeros(1, np.int64)
        return bounds, out


def _space_re2() -> str:
    """White_Space for Arrow's regular expressions."""
    return r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


_ENCODERS: dict[str, BlockEncoder] = {}


def encoder(vocabulary: str) -> BlockEncoder:
    """The worker's encoder; workers are reused, so the vocabulary is read once each."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = BlockEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def blocks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about BLOCK_BYTES of text each, at least one row."""
    lens = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    part = np.cumsum(lens) // BLOCK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lens)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _prepared(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(df[id_col].alias("doc_id"), df[text_col].cast("string").alias("text"))


def encode_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids``: the ids of each text, without special tokens. One row per input row."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for part in blocks(batch, "text"):
                bounds, ids = enc.encode(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    source = _prepared(df, id_col, text_col)
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return source.mapInArrow(run, schema)


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_tokens``: the length of the list that :func:`encode_documents` gives."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for part in blocks(batch, "text"):
                bounds, _ = enc.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(bounds), pa.int64())], ["doc_id", "n_tokens"])

    source = _prepared(df, id_col, text_col)
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType())])
    return source.mapInArrow(run, schema)
