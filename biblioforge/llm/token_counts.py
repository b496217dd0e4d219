"""Token counts under a unigram model, by dynamic programming shared over a trie of pre-tokens.

The pieces are those of a public vocabulary, which comes without unigram scores. The scores are fitted here by hard EM on all words of all
documents: distinct words are counted over the cluster once, and each round segments them there by the current scores (first: the
Zipf-Mandelbrot law of a piece's rank), sums how often each piece was used, and sets its log-probability from that, smoothed with the
first scores. The driver sees the uses of the vocabulary's pieces alone. A pre-token is a run of characters other than
ASCII blanks, with a leading word mark; its count is the number of pieces in its best segmentation: highest summed score,
then fewest pieces; a character that no piece covers falls back to its UTF-8 bytes.

A batch is split and dictionary-encoded by Arrow; its distinct pre-tokens, sorted, form a trie, which is worked through level by
level with numpy: a node is a distinct prefix, its best score is computed once from those of its ancestors, and
the count of a pre-token is stored at its terminal node. A node also carries the state of the vocabulary's own trie for every start
before it, so a piece is recognised by one step from its parent's state. Pre-tokens of over LONG characters, which share
next to nothing, run through the same recursion alone. Counting shuffles nothing; the fit shuffles distinct words and
uses of pieces.

Rules for odd input: null text counts as empty and has 0 words and 0 tokens; a null doc_id stays null; very long words are segmented
like others; repeated rows are counted alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stash, least_hashes, new_path
from .tokens import slices

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: First scores, Zipf-Mandelbrot: log p(rank) = -EXPONENT * log(rank + SHIFT) + constant. A byte scores as UNKNOWN.
EXPONENT, SHIFT, UNKNOWN = 1.0, 2.7, -20.0
#: Rounds of the fit; weight of the first scores, in pieces.
ROUNDS, SMOOTHING = 4, 20_000.0
#: Bounds of sample_words, which no query uses: documents, distinct words.
SAMPLE_DOCS, SAMPLE_WORDS, SEED = 4_000, 200_000, 23
#: Characters up to which a pre-token goes in the trie; words that a worker keeps with their counts.
LONG, CACHE_WORDS = 64, 400_000
BLANKS = r"[^\x20\x09-\x0D]+"


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Log-probability of each piece by its place in the list."""
    raw = -EXPONENT * np.log(np.arange(1, len(pieces) + 1) + SHIFT)
    raw -= math.log(np.exp(raw).sum())
    return dict(zip(pieces, raw.tolist()))


def load_pieces(path: str) -> list[str]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def char_bytes(code: np.ndarray) -> np.ndarray:
    """UTF-8 length of code points."""
    return 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)


class PieceTrie:
    """The vocabulary as a trie: steps from (state, character) to a state, and the score of the piece that ends in a state."""

    def __init__(self, scores: dict[str, float]):
        steps: dict[tuple[int, int], int] = {}
        ends: dict[int, str] = {}
        for piece in scores:
            state = 0
            for c in piece:
                state = steps.setdefault((state, ord(c)), len(steps) + 1)
            ends[state] = piece
        keys = np.array([s << 21 | c for s, c in steps], np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = np.append(keys[order], 1 << 62), np.append(np.array(list(steps.values()), np.int32)[order], -1)
        self.longest = max(map(len, scores), default=1)
        self.score = np.full(len(steps) + 1, -np.inf)
        self.pieces = [ends.get(s) for s in range(len(steps) + 1)]
        self.score[list(ends)] = [scores[p] for p in ends.values()]
        # steps on frequent characters are looked up directly
        self.dense = np.full((len(steps) + 1, 128), -1, np.int32)
        low = [(s, c, t) for (s, c), t in steps.items() if c < 128]
        if low:
            s, c, t = np.array(low).T
            self.dense[s, c] = t

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        out = np.empty(len(state), np.int32)
        plain = code < 128
        out[plain] = self.dense[state[plain], code[plain]]
        if not plain.all():
            key = state[~plain].astype(np.int64) << 21 | code[~plain]
            at = np.searchsorted(self.keys, key)
            out[~plain] = np.where(self.keys[at] == key, self.targets[at], -1)
        return out


class TrieCounter:
    """Counts the pieces of words; forward scores live on the nodes of a trie of the words."""

    def __init__(self, scores: dict[str, float]):
        self.vocabulary = PieceTrie(scores)
        #: Trie nodes worked on so far, and characters they stand for.
        self.nodes = self.characters = 0

    def count(self, words: list[str], uses: np.ndarray | None = None) -> tuple[np.ndarray, dict[str, float]]:
        """(pieces of each word, how often each piece is used). Words are distinct; uses, if given, is how often each word occurs."""
        out, used = np.zeros(len(words), np.int64), {}
        order = sorted(range(len(words)), key=words.__getitem__)
        short = [i for i in order if len(words[i]) <= LONG]
        if short:
            out[short] = self._trie([MARK + words[i] for i in short], None if uses is None else uses[short], used)
        for i in order:
            if len(words[i]) > LONG:
                out[i] = self._alone(MARK + words[i], 0.0 if uses is None else float(uses[i]), used)
        return out, used

    def _trie(self, words: list[str], uses: np.ndarray | None, used: dict[str, float]) -> np.ndarray:
        """Counts of sorted distinct words, level by level; a level's nodes are the distinct prefixes of that length."""
        v, width = self.vocabulary, min(self.vocabulary.longest, LONG + 1)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array(list(map(len, words)))
        begins = np.cumsum(sizes) - sizes
        node, alive = np.zeros(len(words), np.int64), np.arange(len(words))  # node of each word in its level, words still running
        score, pieces = np.zeros(1), np.zeros(1, np.int64)
        # per node, by length l - 1: state of the vocabulary's trie after its last l characters, best score and pieces before them
        states, before_score, before_pieces = np.zeros((1, 0), np.int32), np.zeros((1, 0)), np.zeros((1, 0), np.int64)
        out = np.zeros(len(words), np.int64)
        levels = []
        for depth in range(1, int(sizes.max()) + 1):
            alive = alive[sizes[alive] >= depth]
            code = codes[begins[alive] + depth - 1]
            parent = node[alive]
            fresh = np.ones(len(alive), bool)
            fresh[1:] = (parent[1:] != parent[:-1]) | (code[1:] != code[:-1])
            own = np.cumsum(fresh) - 1
            node[alive] = own
            parent, code = parent[fresh], code[fresh]
            self.nodes += len(code)
            self.characters += len(alive)
            keep = min(depth, width)
            before_score = np.hstack([score[parent][:, None], before_score[parent, : keep - 1]])
            before_pieces = np.hstack([pieces[parent][:, None], before_pieces[parent, : keep - 1]])
            last = np.hstack([np.zeros((len(code), 1), np.int32), states[parent, : keep - 1]])
            states = np.full((len(code), keep), -1, np.int32)
            row, length = np.nonzero(last >= 0)
            states[row, length] = v.step(last[row, length], code[row])
            score, pieces = np.full(len(code), -np.inf), np.zeros(len(code), np.int64)
            chosen = np.zeros(len(code), np.int32)
            for l in range(keep):
                candidate, n = before_score[:, l] + np.where(states[:, l] >= 0, v.score[states[:, l]], -np.inf), before_pieces[:, l] + 1
                better = (candidate > score) | (candidate == score) & (candidate > -np.inf) & (n < pieces)
                score, pieces, chosen = np.where(better, candidate, score), np.where(better, n, pieces), np.where(better, l + 1, chosen)
            lost = score == -np.inf
            if lost.any():
                n = char_bytes(code[lost])
                score[lost], pieces[lost] = before_score[lost, 0] + UNKNOWN * n, before_pieces[lost, 0] + n
            if uses is not None:
                levels.append((parent, chosen, np.where(chosen > 0, states[np.arange(len(code)), np.maximum(chosen, 1) - 1], -1)))
            done = sizes[alive] == depth
            out[alive[done]] = pieces[own[done]]
        if uses is not None:
            self._trace(levels, sizes, begins, codes, uses, used)
        return out

    def _trace(self, levels, sizes, begins, codes, uses, used) -> None:
        """Adds the uses of the pieces on each word's best path. Paths run back through the nodes, all uses of a node at once."""
        mass = [np.zeros(len(code)) for _, code, _ in levels]
        node = np.zeros(len(sizes), np.int64)
        alive = np.arange(len(sizes))
        for depth, (parent, _, _) in enumerate(levels, 1):
            alive = alive[sizes[alive] >= depth]
            code = codes[begins[alive] + depth - 1]
            up = node[alive]
            fresh = np.ones(len(alive), bool)
            fresh[1:] = (up[1:] != up[:-1]) | (code[1:] != code[:-1])
            node[alive] = np.cumsum(fresh) - 1
            done = alive[sizes[alive] == depth]
            np.add.at(mass[depth - 1], node[done], uses[done])
        totals = np.zeros(len(self.vocabulary.score))
        for depth in range(len(levels), 0, -1):
            parent, chosen, state = levels[depth - 1]
            m = mass[depth - 1]
            np.add.at(totals, state[state >= 0], m[state >= 0])
            step, at = np.maximum(chosen, 1), np.arange(len(m))
            for l in range(1, int(step.max(initial=1)) + 1):
                at = levels[depth - l][0][at] if depth - l >= 0 else at  # the ancestors l levels up
                if depth - l >= 1:
                    hit = step == l
                    np.add.at(mass[depth - l - 1], at[hit], m[hit])
        for s in np.flatnonzero(totals):
            piece = self.vocabulary.pieces[s]
            used[piece] = used.get(piece, 0.0) + float(totals[s])

    def _alone(self, word: str, n_uses: float, used: dict[str, float]) -> int:
        """Pieces of one long word, by the same recursion, in memory linear in its length; adds n_uses to those on its best path."""
        v = self.vocabulary
        codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        n = len(codes)
        score, pieces = [0.0] + [-math.inf] * n, [0] * (n + 1)
        state, at = np.zeros(n, np.int32), np.arange(n)
        hits: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for length in range(1, v.longest + 1):  # every start at once, one character further each time
            fits = at + length <= n
            state, at = state[fits], at[fits]
            state = v.step(state, codes[at + length - 1]) if len(at) else state
            live = state >= 0
            state, at = state[live], at[live]
            s = v.score[state]
            for i, x in zip(at[s > -np.inf].tolist(), s[s > -np.inf].tolist()):
                hits[i + length].append((i, x))
        sizes, came = char_bytes(codes).tolist(), [-1] * (n + 1)  # came: where the piece that ends there begins
        for end in range(1, n + 1):
            for start, s in hits[end]:
                total, k = score[start] + s, pieces[start] + 1
                if total > score[end] or total == score[end] and k < pieces[end]:
                    score[end], pieces[end], came[end] = total, k, start
            if not hits[end]:
                score[end], pieces[end] = score[end - 1] + UNKNOWN * sizes[end - 1], pieces[end - 1] + sizes[end - 1]
            hits[end] = []
        end = n if n_uses else 0
        while end:
            if came[end] >= 0:
                used[word[came[end] : end]] = used.get(word[came[end] : end], 0.0) + n_uses
            end = came[end] if came[end] >= 0 else end - 1
        return pieces[n]


def _estimate(first: dict[str, float], used: dict[str, float], smoothing: float) -> dict[str, float]:
    total = sum(used.values()) + smoothing
    return {p: math.log((used.get(p, 0.0) + smoothing * math.exp(s)) / total) for p, s in first.items()}


def fit_scores(first: dict[str, float], words: list[str], uses: np.ndarray, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> dict[str, float]:
    """Hard EM: log-probabilities of the pieces from their uses in the best segmentations of the words."""
    scores = first
    for _ in range(rounds if words else 0):
        scores = _estimate(first, TrieCounter(scores).count(words, uses)[1], smoothing)
    return scores


def sample_words(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS) -> tuple[list[str], np.ndarray]:
    """Distinct words of the sample and how often each occurs in it; both bounds hold whatever the corpus."""
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    chosen = least_hashes(rows.select("doc_id"), docs.count(), F.xxhash64("doc_id", F.lit(SEED)), ["doc_id"], sample_docs)
    words = rows.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi").select(F.explode(F.regexp_extract_all("text", F.lit(BLANKS), F.lit(0))).alias("w"))
    counts = words.where(F.length("w") <= LONG).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    found = counts.orderBy(F.xxhash64("w", F.lit(SEED)), "w").limit(sample_words).collect()
    return [r.w for r in found], np.array([r.n for r in found], np.float64)


def _distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        for a, b in slices(texts):
            counted = pc.value_counts(pc.ascii_split_whitespace(texts.slice(a, b - a)).flatten())
            found = pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], names=["w", "n"])
            yield found.filter(pc.not_equal(found.column("w"), ""))


def word_counts(docs: DataFrame) -> DataFrame:
    """w, n: every distinct word of all texts and how often it occurs, sorted within partitions so that neighbours share prefixes."""
    words = docs.select(F.col("text").cast("string")).mapInArrow(_distinct, "w string, n long")
    return words.groupBy("w").agg(F.sum("n").alias("n")).sortWithinPartitions("w")


def _uses(batches: Iterable[pa.RecordBatch], scores: dict[str, float]) -> Iterator[pa.RecordBatch]:
    """How often the best segmentations of a task's words use each piece."""
    counter, total = TrieCounter(scores), {}
    for batch in batches:
        _, used = counter.count(batch.column("w").to_pylist(), batch.column("n").to_numpy().astype(np.float64))
        for piece, n in used.items():
            total[piece] = total.get(piece, 0) + int(n)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["piece", "n"])


def train(docs: DataFrame, vocabulary: str | None = None, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> dict[str, float]:
    """Unigram scores of the vocabulary's pieces, fitted on all words. Uses are whole numbers, so their sums do not depend on the tasks."""
    first = scores = zipf_scores(load_pieces(vocabulary or public_tokenizers.path(VOCABULARY)))
    spark, path = docs.sparkSession, new_path(docs.sparkSession, "words")
    word_counts(docs).write.parquet(path)
    words = spark.read.schema("w string, n long").parquet(path)
    for _ in range(rounds):
        found = words.mapInArrow(partial(_uses, scores=scores), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
        used = {r.piece: float(r.n) for r in found.collect()}  # a row per piece of the vocabulary at most
        if not used:
            break
        scores = _estimate(first, used, smoothing)
    drop_stash(spark, path)
    return scores


class KeptCounts:
    """Counts of the words met most often, as one Arrow array and one of numbers, bounded by CACHE_WORDS."""

    def __init__(self, counter: TrieCounter, most: int = CACHE_WORDS):
        self.counter, self.most = counter, most
        self.words, self.counts, self.seen = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def of(self, words: pa.StringArray, uses: np.ndarray) -> np.ndarray:
        """Counts of distinct words; the empty one has 0."""
        known = pc.index_in(words, value_set=self.words)
        missing = pc.is_null(known).to_numpy(zero_copy_only=False)
        place = known.fill_null(0).to_numpy().astype(np.int64)
        new = words.filter(pa.array(missing))
        counted, _ = self.counter.count(new.to_pylist())
        counted[pc.equal(new, "").to_numpy(zero_copy_only=False)] = 0
        place[missing] = len(self.words) + np.arange(len(new))
        counts = np.concatenate([self.counts, counted])
        out = counts[place]
        seen = np.concatenate([self.seen >> 1, np.zeros(len(new), np.int64)])
        seen[place] += uses
        table = pa.concat_arrays([self.words, new])
        kept = np.flatnonzero(pc.less_equal(pc.binary_length(table), LONG).to_numpy(zero_copy_only=False))
        if len(kept) > self.most:
            kept = np.sort(kept[np.argpartition(-seen[kept], self.most - 1)[: self.most]])
        self.words, self.counts, self.seen = table.take(pa.array(kept)), counts[kept], seen[kept]
        return out


def _count(batches: Iterable[pa.RecordBatch], scores: dict[str, float]) -> Iterator[pa.RecordBatch]:
    kept = KeptCounts(TrieCounter(scores))
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        for a, b in slices(texts):
            rows = pc.ascii_split_whitespace(texts.slice(a, b - a))
            ends = rows.offsets.to_numpy() - rows.offsets[0].as_py()
            chunks = rows.flatten().dictionary_encode()
            word = chunks.indices.to_numpy()
            counts = kept.of(chunks.dictionary, np.bincount(word, minlength=len(chunks.dictionary)))
            sums = [np.concatenate(([0], np.cumsum(x[word]))) for x in (counts, (counts > 0).astype(np.int64))]
            n_tokens, n_words = (s[ends[1:]] - s[ends[:-1]] for s in sums)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(n_words), pa.array(n_tokens)], names=["doc_id", "n_words", "n_tokens"])


def token_counts(docs: DataFrame, scores: dict[str, float] | None = None, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens of every row; scores: those of train(docs) if not given."""
    scores = train(docs, vocabulary) if scores is None else scores
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_count, scores=scores), "doc_id long, n_words long, n_tokens long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
