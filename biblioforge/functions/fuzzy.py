"""Fuzzy title scores. Plain functions; operators.journals runs them in Arrow batches on distinct values only."""

from __future__ import annotations

from collections import Counter

import numpy as np


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the shorter text."""
    if len(a) > len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & masks.get(c, 0)
        state = (state + hit | state - hit) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> float:
    """Indel similarity in percent: 200 * LCS / (len a + len b)."""
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against windows of the longer one of its own length, cut short at both ends."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0
    n, best = len(short), 0.0
    for end in range(1, len(long) + n):
        window = long[max(0, end - n) : end]
        if window and (window[-1] in short or window[0] in short):
            best = max(best, ratio(short, window))
            if best == 100.0:
                break
    return best


def _tokens(text: str) -> list[str]:
    return text.split()


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(_tokens(a))), " ".join(sorted(_tokens(b))))


def token_set_ratio(a: str, b: str, base=ratio) -> float:
    """Best ratio among the common words, and the common words followed by either side's own."""
    x, y = set(_tokens(a)), set(_tokens(b))
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = (" ".join(filter(None, [both, " ".join(sorted(s))])) for s in (x - y, y - x))
    if both and (not x - y or not y - x):
        return 100.0
    scores = [base(left, right)]
    if both:
        scores += [base(both, left), base(both, right)]
    return max(scores)


def weighted_ratio(a: str, b: str) -> float:
    """Weighted best of the ratios above. 0.95 for word-order scores; for texts of very different length partial
    scores count 0.9, or 0.6 beyond eight times the length."""
    if not a or not b:
        return 0.0
    lengths = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if lengths < 1.5:
        return max(best, 0.95 * token_sort_ratio(a, b), 0.95 * token_set_ratio(a, b))
    scale = 0.9 if lengths <= 8.0 else 0.6
    best = max(best, scale * partial_ratio(a, b))
    words = max(
        partial_ratio(" ".join(sorted(_tokens(a))), " ".join(sorted(_tokens(b)))),
        100.0 if set(_tokens(a)) & set(_tokens(b)) else partial_ratio(" ".join(sorted(set(_tokens(a)))), " ".join(sorted(set(_tokens(b))))),
    )
    return max(best, 0.95 * scale * words)


class TitleIndex:
    """Best match of a text among titles: every pair is scored unless a proven upper bound lies below the cutoff or the best score.

    Bounds, for lengths m and n and an LCS of L: L is at most the number B of shared characters (as multisets), and the texts share
    G >= 3L - m - n - 1 pairs of adjacent characters, as a lost character breaks two pairs of its text and a gained one breaks one. So a
    ratio is at most 200 B / (m + n) and 200 / 3 * (1 + (G + 1) / (m + n)), and a window of any length up to n, the shorter text's,
    scores at most 200 (n + G + 1) / (3n + G + 1). Sorting words keeps the pairs inside words; at most 2 (words - 1) others can be shared."""

    def __init__(self, titles: list[str], order: np.ndarray, weighted: bool):
        self.titles, self.order, self.weighted = titles, np.asarray(order, np.int64), weighted
        posts: tuple[dict, ...] = ({}, {}, {})  # characters, pairs, words: key -> [(title, count)]
        sizes = []
        for i, text in enumerate(titles):
            parts = self._parts(text)
            sizes.append(parts[3])
            for post, counts in zip(posts, parts[:3]):
                for key, n in counts.items():
                    post.setdefault(key, ([], []))[0].append(i)
                    post[key][1].append(n)
        self.posts = [{k: (np.array(i, np.int32), np.array(n, np.int32)) for k, (i, n) in post.items()} for post in posts]
        self.sizes = np.array(sizes, np.int64).reshape(-1, 6).T

    def _parts(self, text: str) -> tuple[Counter, Counter, Counter, tuple[int, ...]]:
        """Characters, pairs, words; and the lengths as it is, sorted, and sorted without repeats, with the words of either, and the blanks."""
        chars, pairs = Counter(text), Counter(map("".join, zip(text, text[1:])))
        if not self.weighted:
            return chars, pairs, Counter(), (len(text), 0, 0, 0, 0, 0)
        tokens = _tokens(text)
        unique = set(tokens)
        blanks = sum(n for c, n in chars.items() if c.isspace())
        return chars, pairs, Counter(unique), (len(text), len(" ".join(tokens)), len(tokens), len(" ".join(unique)), len(unique), blanks)

    def _shared(self, which: int, counts: Counter, wanted=lambda key: True) -> np.ndarray:
        out = np.zeros(len(self.titles), np.int64)
        for key, n in counts.items():
            if key in self.posts[which] and wanted(key):
                at, held = self.posts[which][key]
                out[at] += np.minimum(held, n)
        return out

    def _bounds(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds of all titles' scores; and the score of those where it is known from a shared word alone, else -1."""
        chars, pairs, words, (n, ns, t, nu, u, _) = self._parts(text)
        m, ms, mt, mu, mw, _ = self.sizes
        blank = lambda key: any(c.isspace() for c in key)
        inside = self._shared(1, pairs, lambda key: not blank(key))
        letters = self._shared(0, chars, lambda key: not blank(key))
        b = letters + self._shared(0, chars, blank)
        g = inside + self._shared(1, pairs, blank)

        def whole(b, g, size):
            size = np.maximum(size, 1)
            return np.minimum(np.minimum(200.0 * b / size, 200.0 / 3 * (1 + (g + 1) / size)), 100.0)

        def part(g, least):
            least = np.maximum(least, 1)
            g = np.minimum(g, least - 1)
            return 200.0 * (least + g + 1) / (3 * least + g + 1)

        bound = whole(b, g, m + n)
        known = np.full(len(self.titles), -1.0)
        if not self.weighted:
            return bound, known
        both = np.zeros(len(self.titles), np.int64)
        for word in words:
            if word in self.posts[2]:
                both[self.posts[2][word][0]] += len(word) + 1
        held, both = both > 0, np.maximum(both - 1, 0)
        gaps, gaps_u = np.minimum(mt, t) - 1, np.minimum(mw, u) - 1
        in_sort = whole(letters + gaps, inside + 2 * gaps, ms + ns)
        in_set = np.maximum(whole(letters + gaps_u, inside + 2 * gaps_u, mu + nu), np.where(held, 200.0 * both / np.maximum(both + np.minimum(mu, nu), 1), 0.0))
        lengths = np.maximum(m, n) / np.minimum(m, n)
        near = lengths < 1.5
        scale = np.where(lengths <= 8.0, 0.9, 0.6)
        floor = 0.95 * scale * 100.0
        pieces = np.maximum(bound, scale * part(g, np.minimum(m, n)))
        in_words = np.where(held, 100.0, np.maximum(part(inside + 2 * gaps, np.minimum(ms, ns)), part(inside + 2 * gaps_u, np.minimum(mu, nu))))
        known = np.where(~near & held & (pieces < floor - 1e-6), floor, known)
        bound = np.where(near, np.maximum(bound, 0.95 * np.maximum(in_sort, in_set)), np.maximum(pieces, 0.95 * scale * in_words))
        return np.where((mt == 0) | (t == 0), 100.0, bound), known

    def best(self, text: str, cutoff: float) -> tuple[int, float] | None:
        """(title, score) of the best score at or above cutoff, the least order among equals; None without any."""
        if not self.titles:
            return None
        bound, known = self._bounds(text)
        score, found = weighted_ratio if self.weighted else ratio, None
        at = np.flatnonzero((known >= 0) & (known >= cutoff))
        if len(at):
            i = at[np.lexsort((self.order[at], -known[at]))[0]]
            found = (float(known[i]), -int(self.order[i]), int(i))
        at = np.flatnonzero((known < 0) & (bound + 1e-6 >= cutoff))
        for i in at[np.lexsort((self.order[at], -bound[at]))].tolist():
            if found and bound[i] + 1e-6 < found[0]:
                break
            s = score(text, self.titles[i])
            if s >= cutoff and (found is None or (s, -int(self.order[i])) > found[:2]):
                found = (s, -int(self.order[i]), i)
        return (found[2], found[0]) if found else None

