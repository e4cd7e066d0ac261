"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces of the capacity and the binary digits
of the rest (largest first).  Every piece is a sequence of its own, so no sequence
crosses documents, none is padded, and pieces of equal length share a bucket.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cribble.llm.bpe import Merger
from cribble.llm.common import ranges, slices
from cribble.llm.idcache import IdCache

# letters whose lower case is one letter and which no normalisation joins or splits
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long, bucket int")


def piece_lengths(n: int, capacity: int) -> list[int]:
    """``capacity`` as often as it fits, then the binary digits of the rest, largest first."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


class WordTokenizer:
    """Ids of whole texts from the ids of their distinct words.

    Holds for vocabularies that drop white space before the merges: a text's ids are
    then the ids of its space-separated chunks in a row.  Chunks are encoded once and
    remembered across the tasks of a worker (``IdCache``).
    """

    def __init__(self, spec: str, remember: int = 1_000_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(spec)
        self.cache = IdCache(self._words, remember)
        self.merger, self.inner, self.last = self._merges(json.loads(spec)["model"])

    @staticmethod
    def _merges(model: dict) -> tuple[Merger | None, np.ndarray, np.ndarray]:
        """Merger of the vocabulary and the first ids of the bytes inside and at the end of a word; no merger where
        ids do not follow the order of the merges, or where bytes have no id."""
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = [vocab[a + b] for a, b in pairs]
        # byte-level vocabularies write a byte as a printable character: itself, or the next one from 256 on
        shown, other = {}, 256
        for b in range(256):
            if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
                shown[b] = chr(b)
            else:
                shown[b], other = chr(other), other + 1
        known = all(c in vocab and c + end in vocab for c in shown.values())
        if not known or any(x >= y for x, y in zip(ids, ids[1:])):
            return None, np.zeros(0), np.zeros(0)
        table = {(vocab[a], vocab[b]): i for (a, b), i in zip(pairs, ids)}
        return (Merger(table), np.array([vocab[shown[b]] for b in range(256)], np.int32),
                np.array([vocab[shown[b] + end] for b in range(256)], np.int32))

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of every word.  Words of Latin letters alone are one piece, whose bytes are merged here."""
        plain = [i for i, w in enumerate(words) if LATIN.fullmatch(w)] if self.merger else []
        out = [b""] * len(words)
        if plain:
            lower = [words[i].lower().encode() for i in plain]
            size = np.array([len(w) for w in lower], np.int64)
            raw = np.frombuffer(b"".join(lower), np.uint8)
            flat, end = self.inner[raw], np.cumsum(size) - 1
            flat[end] = self.last[raw[end]]
            for i, ids in zip(plain, self.merger.merge(flat, size)):
                out[i] = ids
        done = set(plain)
        rest = [i for i in range(len(words)) if i not in done]
        for i, e in zip(rest, self.tok.encode_batch([words[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32).tobytes()
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in a row, number of ids per row)."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        # a comma or stop between a letter and a space is a token of its own either way
        texts = pc.replace_substring_regex(texts, r"([A-Za-z])([,.])( |$)", r"\1 \2\3")
        lists = pc.split_pattern(texts, " ")
        enc = lists.flatten().dictionary_encode()
        words = enc.dictionary
        plain = pc.and_(pc.string_is_ascii(words), pc.utf8_is_alpha(words))
        flat, starts, sizes = self.cache.look(pc.if_else(plain, pc.ascii_lower(words), words))
        code = enc.indices.to_numpy(zero_copy_only=False)
        per_word = sizes[code]
        ids = flat[ranges(starts[code], per_word)]
        done = np.concatenate(([0], np.cumsum(per_word)))
        return ids, np.diff(done[lists.offsets.to_numpy() - lists.offsets[0].as_py()])


def word_tokenizer(spec: str) -> WordTokenizer:
    """The tokenizer of this worker process, kept between its tasks."""
    kept = sys.modules.setdefault("_cribble_llm_tokenizers", types.ModuleType("_cribble_llm_tokenizers"))
    key = f"w{hash(spec)}"
    if not hasattr(kept, key):
        setattr(kept, key, WordTokenizer(spec))
    return getattr(kept, key)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 4096) -> DataFrame:
    """Pieces of all documents, one sequence each: (doc_id, start, length, ids, doc_tokens,
    sequence_id, offset, bucket).

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers,
    ``bucket`` is log2 of the length.  A document is its ids followed by ``end_id``, so a
    null or empty text is one piece with that id alone.  Repeated rows are packed once
    each, a null doc_id stays null, other columns of ``docs`` are ignored, no rows give
    no rows.  The tokenizer file (bounded, read by the driver) goes out as a broadcast.
    Rows never leave their task: there is no shuffle, whatever the sizes.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(spec.value)
        next_id = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text", 4 << 20):
            ids, counts = tok.encode(batch.column("text"))
            n = counts + 1
            flat = np.full(int(n.sum()), end_id, np.uint32)
            first = np.cumsum(n) - n
            flat[ranges(first, counts)] = ids
            lens = [piece_lengths(int(x), capacity) for x in n]
            per = np.array([len(x) for x in lens], np.int64)
            length = np.array([y for x in lens for y in x], np.int64)
            at = np.cumsum(length) - length
            row = np.repeat(np.arange(len(n)), per)
            offsets = np.concatenate((at, [len(flat)])) * 4
            # pieces go out in slabs: each output batch stays near 8 MB
            for lo, hi in _slabs(offsets, 8 << 20):
                pieces = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), hi - lo,
                    [None, pa.py_buffer((offsets[lo:hi + 1] - offsets[lo]).astype(np.int64)),
                     pa.py_buffer(flat[offsets[lo] // 4:offsets[hi] // 4])]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(row[lo:hi])),
                    pa.array(at[lo:hi] - first[row[lo:hi]]),
                    pa.array(length[lo:hi]), pieces, pa.array(n[row[lo:hi]]),
                    pa.array(np.arange(next_id + lo, next_id + hi)),
                    pa.array(np.zeros(hi - lo, np.int64)),
                    pa.array(np.log2(length[lo:hi]).astype(np.int32)),
                ], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "bucket"])
            next_id += len(length)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _slabs(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi
