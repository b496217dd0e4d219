"""Token ids from a public vocabulary through the tokenizers library, once per distinct word of a batch.

The vocabulary never merges across white space, and its normaliser neither composes nor folds across it, so a text's ids are
the concatenation of the ids of its white-space chunks. A batch of texts is split and dictionary-encoded by Arrow; the library
sees each distinct chunk once, and ids are gathered by numpy offsets, without a Python step per word. Chunks of Latin-1
characters are lower-cased first, as the vocabulary does, and one sign behind a word of letters is a piece of its own, as its split
pattern has it; all other chunks go to the library as they are, so one odd character costs its own chunk only.

A worker carries the chunks it met most often to its next batches: one Arrow string array and one array of ids, bounded by CACHE_CHUNKS.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from .common import give_back

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("token ids are handled as native little-endian 32-bit integers")

WORD_VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Chunks that a worker keeps for its next batches, and the longest kept: about 30 bytes an entry.
CACHE_CHUNKS, CACHE_LENGTH = 400_000, 64
#: Bytes of text worked on at once; a longer text is worked on alone.
SLICE_BYTES = 4 << 20
#: Chunks in which Arrow's lower case equals the vocabulary's, whatever stands beside a character.
PLAIN = "^[\x21-\x7e\xa1-\xac\xae-\xff]*$"
#: Latin-1 letters; a word of them is one pre-token, and one of these signs behind it is another.
LETTERS, SIGNS = "[a-zA-Z\xb5\xc0-\xd6\xd8-\xf6\xf8-\xff]+", ".,;:!?"
#: Words joined to one text for the library.
JOINED = 50


class BatchEncoder:
    """Ids of whole texts; equal to encoding each text by the library on its own."""

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        self.tokenizer = Tokenizer.from_file(path)
        # a lower-cased word of letters is one pre-token already: only the byte alphabet and the merges are left to do
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        for tokenizer in (self.tokenizer, self.merges):
            tokenizer.model._resize_cache(0)  # every chunk is asked for once
        vocabulary = self.tokenizer.get_vocab()
        #: Type of the ids: two bytes where the vocabulary allows it.
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        #: Whether an id ends a word.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.sign_ids = np.array([self.tokenizer.encode(c, add_special_tokens=False).ids[0] for c in SIGNS] + [0], self.dtype)
        self.cache_chunks = cache_chunks
        self.keys, self.ids = pa.array([], pa.string()), np.zeros(0, self.dtype)
        self.lengths, self.seen = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _ask_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each) for lower-case words of letters; an id of a word's end tells them apart."""
        texts, parts = words.to_pylist(), [np.zeros(0, np.uint32)]
        joined = [" ".join(texts[a : a + JOINED]) for a in range(0, len(texts), JOINED)]
        for a in range(0, len(joined), 256):
            parts += [np.array(e.ids, np.uint32) for e in self.merges.encode_batch_fast(joined[a : a + 256], add_special_tokens=False)]
        ids = np.concatenate(parts)
        lengths = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        if len(lengths) != len(texts):
            raise ValueError("the vocabulary does not mark the ends of words")
        return ids.astype(self.dtype), lengths.astype(np.int32)

    def _ask_chunks(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, number of ids of each) for any chunks."""
        ids, lengths = array("I"), np.zeros(len(chunks), np.int32)
        for a in range(0, len(chunks), 1_024):
            for i, e in enumerate(self.tokenizer.encode_batch_fast(chunks[a : a + 1_024].to_pylist(), add_special_tokens=False), a):
                found = e.ids
                lengths[i] = len(found)
                ids.extend(found)
        return np.frombuffer(ids, np.uint32).astype(self.dtype), lengths

    def _table(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray, np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct chunks: key of each and its closing sign's id (0: none), then keys, ids, starts and lengths of keys."""
        plain = pc.and_(pc.match_substring_regex(chunks, PLAIN), pc.invert(pc.match_substring(chunks, "<|")))
        closed = pc.match_substring_regex(chunks, f"^{LETTERS}[{SIGNS}]$")
        bare = pc.if_else(closed, pc.utf8_slice_codeunits(chunks, 0, -1), chunks)
        keys = pc.if_else(plain, pc.utf8_lower(bare), bare).dictionary_encode()
        last = pc.index_in(pc.utf8_slice_codeunits(chunks, -1), value_set=pa.array(list(SIGNS)))
        sign = self.sign_ids[pc.if_else(closed, last, len(SIGNS)).to_numpy(zero_copy_only=False).astype(np.int64)]
        known = pc.index_in(keys.dictionary, value_set=self.keys)
        new = keys.dictionary.filter(pc.is_null(known))
        word = pc.match_substring_regex(new, f"^{LETTERS}$")
        asked = [self._ask_words(new.filter(word)), self._ask_chunks(new.filter(pc.invert(word)))]
        word = word.to_numpy(zero_copy_only=False)
        # the kept keys and behind them the new ones, words first
        place = known.fill_null(0).to_numpy().copy()
        rank = np.empty(len(new), place.dtype)
        rank[word], rank[~word] = np.arange(word.sum()), word.sum() + np.arange((~word).sum())
        place[pc.is_null(known).to_numpy(zero_copy_only=False)] = len(self.keys) + rank
        ids = np.concatenate([self.ids, *(a for a, _ in asked)])
        lengths = np.concatenate([self.lengths, *(n for _, n in asked)])
        order = np.argsort(rank, kind="stable")
        table = pa.concat_arrays([self.keys, new.take(pa.array(order))])
        return place[keys.indices.to_numpy()], sign, table, ids, np.cumsum(lengths, dtype=np.int64) - lengths, lengths

    def encode(self, texts: pa.StringArray, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of text k are ids[offsets[k] : offsets[k + 1]]; a null text counts as empty."""
        rows = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        row_ends, chunks = rows.offsets.to_numpy() - rows.offsets[0].as_py(), rows.flatten().dictionary_encode()
        key, sign, keys, ids, starts, lengths = self._table(chunks.dictionary)
        # ids of the distinct chunks, with their signs
        chunk_ids, chunk_ends = gather(ids, starts[key], lengths[key])
        signed = sign > 0
        chunk_ids = np.insert(chunk_ids, chunk_ends[signed], sign[signed])
        chunk_size = lengths[key] + signed
        chunk_starts = np.cumsum(chunk_size, dtype=np.int64) - chunk_size
        word = chunks.indices.to_numpy()
        out, ends = gather(chunk_ids, chunk_starts[word], chunk_size[word])
        offsets = np.concatenate(([0], ends))[row_ends]
        if end_id is not None:
            out = np.insert(out, offsets[1:], np.array(end_id, self.dtype))
            offsets = offsets + np.arange(len(offsets))
        seen = np.bincount(key, np.bincount(word, minlength=len(key)), len(lengths)).astype(np.int32)
        self._keep(keys, ids, starts, lengths, seen)
        return out, offsets

    def _keep(self, keys: pa.StringArray, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seen: np.ndarray) -> None:
        """Carry the keys met most often, at most cache_chunks of them; older meetings count half each time."""
        seen[: len(self.seen)] += self.seen >> 1
        kept = np.flatnonzero(pc.less_equal(pc.binary_length(keys), CACHE_LENGTH).to_numpy(zero_copy_only=False))
        if len(kept) > self.cache_chunks:
            kept = np.sort(kept[np.argpartition(-seen[kept], self.cache_chunks - 1)[: self.cache_chunks]])
        self.ids, _ = gather(ids, starts[kept], lengths[kept])
        self.keys, self.lengths, self.seen = keys.take(pa.array(kept)), lengths[kept], seen[kept]


def gather(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the ranges ids[start : start + size] one behind the other, where each ends)."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
    where = np.repeat((starts - (ends - sizes)).astype(kind), sizes)
    where += np.arange(total, dtype=kind)
    return ids[where], ends


@lru_cache(maxsize=2)
def encoder(path: str) -> BatchEncoder:
    """One per worker process and vocabulary."""
    return BatchEncoder(path)


def slices(texts: pa.StringArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `most` bytes each, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, most + (ends[a - 1] if a else 0), "right")))
        yield a, b
        a = b


def encode_batch(texts: pa.Array, path: str, end_id: int | None = END_ID) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(a, b, ids, offsets) of texts a to b, slice by slice."""
    for a, b in slices(texts):
        yield a, b, *encoder(path).encode(texts.slice(a, b - a), end_id)
    give_back()


def vocabulary_path(name: str = WORD_VOCABULARY) -> str:
    return public_tokenizers.path(name)


def encode_ids(text: str | None, path: str | None = None, end_id: int | None = END_ID) -> bytes:
    """The ids of one whole text as little-endian unsigned 32-bit integers."""
    ids, _ = encoder(path or vocabulary_path()).encode(pa.array([text], pa.string()), end_id)
    return ids.astype("<u4").tobytes()
