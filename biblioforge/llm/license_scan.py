"""Licence scans: a trained paragraph classifier with an unknown class, confirmed against templates.

Paragraphs end at blank lines and behind lines that end in a full stop, colon, question or exclamation mark, so hard-wrapped notices
stay whole. Features are the distinct word n-grams of 1 to 3 words; a sparse softmax regression (L1) over the licence families and
"unknown" is trained on the templates (license_texts: paragraphs of the licences, and sentences around their names), variants of them, the same
sentences around other names, sentences that use licence words otherwise, and as further "unknown"
ones NEGATIVES paragraphs of the corpus that hold little of any template (those with the least seeded hashes: a documented
bound). N-grams that COMMON of these hold are no features. Every paragraph is judged. The threshold is calibrated on unknown paragraphs that the fit did not see and that could be
confirmed, two halves in turn. A prediction stands only if its probability reaches the threshold, and is confirmed only if enough of the word
pairs of one of the family's templates are in the paragraph, or enough of a short paragraph's pairs are in the template, and with
them a pair that no other family's template has; else the paragraph is "unknown". A paragraph of one word is never confirmed.

The classifier's "unknown" class does the rejecting. A paragraph can leave it only by n-grams that speak for a family by more than
the bias of "unknown"; the words of a paragraph bound what its n-grams can add up to (word_bounds, from the model itself), and
paragraphs whose bound falls short are rejected at once, without an effect on the result.
Scoring is DataFrame functions alone: n-grams are exploded and joined with the weight table, whose size is bounded by the
templates.

Rules for odd input: null or empty texts have no paragraphs with words; very long paragraphs are scanned whole; each row is scanned on its
own, whatever its doc_id: repeated rows give repeated results and a null doc_id stays null; equally likely families go to the
first as listed; an empty table gives no rows; extra columns, also of clashing names, are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import least_hashes, stash
from .license_texts import FRAMES, NAMES, SHORT, SPDX, notices, other_notices

UNKNOWN = "unknown"
WORD = r"[a-z0-9]+"
#: Blank lines, and line breaks behind the end of a sentence.
BREAK = r"\n[ \t\r]*\n|(?<=[.:!?])[ \t\r]*\n"
MIN_CONTAINED, MIN_SHARED, L1, STEPS, SMALLEST = 0.6, 2, 1e-4, 200, 0.05
#: Least threshold: the templates must agree as well.
LEAST_THRESHOLD = 0.3
#: Corpus paragraphs taken as unknown, and the share of them from which on an n-gram counts as common and is no feature.
NEGATIVES, SEED, COMMON = 3_000, 31, 0.01
#: Public notices of each family, and the half that each lies in.
HALVES = {text: half for texts in (*notices().values(), other_notices()) for text, half in texts}
TEMPLATES = {family: tuple(text for text, _ in texts) for family, texts in notices().items()}
#: Sentences that use anchor words without stating a licence.
OTHERS = (
    "He renewed his driving licence at the town hall.",
    "The bar lost its license to serve alcohol after midnight.",
    "You need permission from your parents to join the trip.",
    "The permission was granted by the ministry in the spring.",
    "A fishing license costs ten dollars a year in this state.",
    "Copyright is a wide field of law that students find hard.",
    "The redistribution of wealth was the topic of the debate.",
    "The book is in the public domain in some countries.",
    "She is a licensed nurse and works at the general hospital.",
    "Poetic license allows the writer to change the version of the tale.",
    "The film was released under the title of the novel.",
    "The software license server was down, so the work had to wait.",
    "The public was asked to note the terms of use of the library.",
    "The source of the river is free of any source of waste.",
)
PREFIXES = ("", "this file is", "unless stated otherwise", "text and images")
SUFFIXES = ("", "see the file for details", "all contributions included", "2021")
FRAMED = frozenset(frame.format(name=n) for frame in FRAMES for group in (NAMES, SHORT) for names in group.values() for n in names) | {text for text, _ in other_notices()}
#: Texts of so many words are also learnt with words left out, but never words of a name.
LONG = 12
NAME_WORDS = frozenset(re.findall("[a-z0-9]+", " ".join(n for group in (NAMES, SHORT, SPDX) for names in group.values() for n in names).lower()))


def words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def ngrams(tokens: list[str]) -> list[str]:
    return sorted({" ".join(tokens[i : i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)})


def _pairs(tokens: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(tokens, tokens[1:])}


def contained(pairs: set[str], template: set[str], own: set[str]) -> float:
    """Share of the template's word pairs in the paragraph, or of the paragraph's in the template if they share MIN_SHARED; 0 if they
    share none of own, the pairs that only the template's family has."""
    shared = pairs & template
    if shared.isdisjoint(own):
        return 0.0
    return max(len(shared) / len(template), len(shared) / len(pairs) if len(shared) >= MIN_SHARED else 0.0)


def _examples() -> list[tuple[list[str], str, int]]:
    """(words, family, half): every text, those that are no sentence of FRAMES with something before or behind them, and long ones with words left out
    or cut short, as far as what is left tells the family.
    All of a text's forms lie in its half."""
    sources = [(t, f, HALVES.get(t, i % 2)) for f, ts in TEMPLATES.items() for i, t in enumerate(ts)]
    sources += [(t, UNKNOWN, half) for t, half in other_notices()] + [(t, UNKNOWN, i % 2) for i, t in enumerate(OTHERS)]
    out, telling = [], telling_pairs()
    for n, (text, family, half) in enumerate(sources):
        body = words(text)
        out.append((body, family, half))
        if text not in FRAMED:
            out += [(words(PREFIXES[(n + k) % 4]) + body + words(SUFFIXES[(n // 4 + k) % 4]), family, half) for k in (1, 2)]
        if len(body) >= LONG:
            out += [([w for i, w in enumerate(body) if (i + n) % 11 != k or w in NAME_WORDS], family, half) for k in (0, 4, 8)]
            out += [(part, family, half) for part in (body[: len(body) * 5 // 8], body[: len(body) // 3 + 4], body[len(body) // 2 :]) if family == UNKNOWN or not _pairs(part).isdisjoint(telling.get(family, ()))]
    return out


@lru_cache(maxsize=1)
def vocabulary() -> list[str]:
    """The n-grams of two or more training texts: the only features there are."""
    return sorted(g for g, n in Counter(g for w, _, _ in _examples() for g in ngrams(w)).items() if n > 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


class _Sparse:
    """A 0/1 matrix by its entries, in order of rows and of columns."""

    def __init__(self, rows: list[list[int]], n_columns: int):
        self.row, self.column = np.repeat(np.arange(len(rows)), list(map(len, rows))), np.array([c for r in rows for c in r], np.int64)
        self.shape, order = (len(rows), n_columns), np.argsort(self.column, kind="stable")
        self.by_row = (self.column, *self._groups(self.row))
        self.by_column = (self.row[order], *self._groups(self.column[order]))

    @staticmethod
    def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[starts], starts

    @staticmethod
    def _sums(values: np.ndarray, groups: tuple, n: int) -> np.ndarray:
        at, keys, starts = groups
        out = np.zeros((n, values.shape[1]))
        if len(keys):
            out[keys] = np.add.reduceat(values.astype(np.float32)[at], starts)
        return out

    def times(self, w: np.ndarray) -> np.ndarray:
        return self._sums(w, self.by_row, self.shape[0])

    def transposed_times(self, g: np.ndarray) -> np.ndarray:
        return self._sums(g, self.by_column, self.shape[1])


def _fit(x: _Sparse, labels: np.ndarray, n_families: int) -> tuple[np.ndarray, np.ndarray]:
    """Accelerated proximal gradient: weights (features x families) and bias, classes balanced."""
    y = np.eye(n_families)[labels]
    balance = (1 / (np.maximum(y.sum(0), 1)[labels] * n_families))[:, None]
    w, bias = np.zeros((x.shape[1], n_families)), np.zeros(n_families)
    step, look, t = 2.0 / max(int(np.bincount(x.row, minlength=1).max()), 1) * n_families, w.copy(), 1.0
    for _ in range(STEPS):
        g = (_softmax(x.times(look) + bias) - y) * balance
        new = look - step * x.transposed_times(g)
        new = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
        bias = bias - step * g.sum(0)
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / t_next * (new - w), new, t_next
    return w, bias


def train(negatives: list[list[str]] = ()) -> dict:
    """negatives: n-grams (of the vocabulary) of unknown paragraphs -> families, bias, weights {ngram: per family}, threshold,
    and recall and false of the halves that the fit did not see."""
    common = {g for g, n in Counter(g for grams in negatives for g in grams).items() if n > COMMON * len(negatives)}
    families, names = [UNKNOWN, *TEMPLATES], [g for g in vocabulary() if g not in common]
    where = {g: i for i, g in enumerate(names)}
    # without paragraphs of a corpus its words stand in for them, each alone
    unknown = negatives or [[g] for g in names if " " not in g]
    rows = [(ngrams(w), families.index(f), half) for w, f, half in _examples()] + [(g, 0, i % 2) for i, g in enumerate(unknown)]
    x = [[where[g] for g in grams if g in where] for grams, _, _ in rows]
    labels, half = np.array([k for _, k, _ in rows]), np.array([h for _, _, h in rows])

    def part(chosen: np.ndarray) -> _Sparse:
        return _Sparse([x[i] for i in np.flatnonzero(chosen)], len(names))

    wrong, right, telling = [], [], telling_pairs()
    for seen in (0, 1):
        w, bias = _fit(part(half == seen), labels[half == seen], len(families))
        p, truth = _softmax(part(half != seen).times(w) + bias), labels[half != seen]
        # an unknown paragraph errs only where it has a pair that tells the family it is taken for, as no other can be confirmed
        held = [bool(telling.get(families[k], set()).intersection(rows[i][0])) for i, k in zip(np.flatnonzero(half != seen), p[:, 1:].argmax(1) + 1)]
        wrong.append(np.where(np.array(held), p[:, 1:].max(1), 0.0)[truth == 0])
        # a family of one template cannot be known to the half without it
        known = np.isin(truth, labels[half == seen]) & (truth > 0)
        right.append(np.where(p[known].argmax(1) == truth[known], p[known].max(1), 0.0))
    wrong, right = np.concatenate(wrong), np.concatenate(right)
    # 99.5 % of the unseen unknown paragraphs stay below it
    threshold = min(max(LEAST_THRESHOLD, float(np.quantile(wrong, 0.995))), 0.95)
    w, bias = _fit(part(half >= 0), labels, len(families))
    w[np.abs(w) < SMALLEST] = 0
    kept = {g: [round(float(v), 6) for v in w[i]] for g, i in where.items() if w[i].any()}
    return {
        "families": families, "bias": [round(float(b), 6) for b in bias], "weights": kept, "threshold": round(threshold, 6),
        "recall": float((right >= threshold).mean()), "false": float((wrong >= threshold).mean()),
    }


def word_bounds(model: dict, uses: Counter | None = None) -> tuple[dict[str, list[float]], list[float]]:
    """({word: a bound per family}, gap per family): a paragraph is judged to be of a family only if the bounds of its distinct words add up to more
    than that family's gap. Each n-gram that speaks for a family against unknown counts at its rarest word (uses: how common words are);
    a word that speaks against the family counts as it is."""
    unknown, *others = model["bias"]
    bounds: dict[str, list[float]] = {}
    for gram, (u, *families) in sorted(model["weights"].items()):
        tokens = gram.split()
        word = min(tokens, key=lambda w: ((uses or {}).get(w, 0), w))
        own = bounds.setdefault(word, [0.0] * len(families))
        for k, w in enumerate(families):
            if w > u or len(tokens) == 1:
                own[k] = round(own[k] + w - u, 6)
    return {w: b for w, b in bounds.items() if any(b)}, [round(unknown - b - 1e-4, 6) for b in others]


GENERIC = frozenset("license licence public software identifier terms".split())


def _version(word: str) -> bool:
    return word.isdigit() or word in ("v", "version", "only", "or", "later")


@lru_cache(maxsize=1)
def template_pairs() -> list[tuple[str, int, str, int, int]]:
    """(family, template, word pair, pairs of the template, 1 if the pair tells the family: no other family has it, and it is more than a version
    and words that any licence has)."""
    texts = [(f, _pairs(words(t))) for f, ts in TEMPLATES.items() for t in ts]
    of_family = {f: set().union(*(ps for g, ps in texts if g == f)) for f in TEMPLATES}
    holders = Counter(pair for pairs in of_family.values() for pair in pairs)

    def tells(pair: str) -> bool:
        return holders[pair] == 1 and any(not _version(w) and w not in GENERIC for w in pair.split())

    return [(f, n, pair, len(ps), int(tells(pair))) for n, (f, ps) in enumerate(texts) for pair in sorted(ps)]


def telling_pairs() -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for family, _, pair, _, tells in template_pairs():
        if tells:
            out.setdefault(family, set()).add(pair)
    return out


def _parts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.posexplode(F.split(F.col("text").cast("string"), BREAK)).alias("paragraph", "part"))


def _tokens():
    return F.regexp_extract_all(F.lower("part"), F.lit(WORD), F.lit(0)).alias("tokens")


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph (from 0), tokens of the paragraphs that have words."""
    return _parts(docs).select("doc_id", "paragraph", _tokens()).where(F.size("tokens") > 0)


def _grams(n: int):
    t = F.col("tokens")
    if n == 1:
        return t
    starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(t, i, n), " "))


def _exploded(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(*keys, F.explode(F.array_distinct(F.concat(_grams(1), _grams(2), _grams(3)))).alias("gram"))


def negatives_of(docs: DataFrame, most: int = NEGATIVES) -> tuple[list[list[str]], Counter]:
    """(n-grams of the vocabulary of at most `most` paragraphs that hold under a third of any template, how many paragraphs have each word)."""
    spark = docs.sparkSession
    # only the chosen paragraphs are cut to words
    parts = _parts(docs).where(F.trim("part") != "").select(F.xxhash64("doc_id", "paragraph", F.lit(SEED)).alias("h"), "part")
    chosen = least_hashes(parts, docs.count(), F.col("h"), [F.xxhash64("part")], most)
    chosen = stash(chosen.select(F.monotonically_increasing_id().alias("uid"), _tokens()), "licence-negatives")
    # one short row per n-gram of the templates
    known = F.broadcast(spark.createDataFrame([(g,) for g in vocabulary()], "gram string"))
    found = _exploded(chosen, "uid").join(known, "gram").groupBy("uid").agg(F.sort_array(F.collect_list("gram")).alias("grams")).collect()
    holders: dict[str, list[tuple[int, int]]] = {}
    for _, n, pair, size, _ in template_pairs():
        holders.setdefault(pair, []).append((n, size))
    out = []
    for row in sorted(found, key=lambda r: r.grams):
        shared = Counter(template for gram in row.grams for template in holders.get(gram, ()))
        if all(3 * n < size for (_, size), n in shared.items()):
            out.append(row.grams)
    return out, Counter(w for grams in out for w in grams if " " not in w)


def _near(rows: DataFrame, bounds: dict[str, list[float]], gaps: list[float]) -> DataFrame:
    """Paragraphs whose words may add up to a family: first by each word's largest bound, which few words have, then family by family."""

    def held(words: list[str]):
        return F.array_intersect("tokens", F.array(*[F.lit(w) for w in words]))

    def table(values: dict):
        return F.create_map(*[x for w, v in values.items() for x in (F.lit(w), v)])

    most = {w: max(b) for w, b in bounds.items() if max(b) > 0}
    if not most:
        return rows.where(F.lit(False))
    rough = table({w: F.lit(v) for w, v in most.items()})
    rows = rows.where(F.aggregate(held(list(most)), F.lit(0.0), lambda total, w: total + F.element_at(rough, w)) > min(gaps))
    each = table({w: F.array(*map(F.lit, b)) for w, b in bounds.items()})
    start = F.array(*[F.lit(0.0)] * len(gaps))
    totals = F.aggregate(held(list(bounds)), start, lambda acc, w: F.zip_with(acc, F.element_at(each, w), lambda a, b: a + b))
    return rows.where(F.exists(F.zip_with(totals, F.array(*map(F.lit, gaps)), lambda t, g: t > g), lambda x: x))


def scan(docs: DataFrame, model: dict, gate: tuple[dict[str, list[float]], list[float]] | None = None, min_contained: float = MIN_CONTAINED) -> DataFrame:
    """One row per paragraph that the classifier does not call unknown: doc_id, paragraph, said, probability, contained, confirmed, and
    family: what it said if that stands and is confirmed, else unknown."""
    spark = docs.sparkSession
    families, template_rows = model["families"], template_pairs()
    # all three tables are bounded by the templates: a few thousand short rows
    weights = F.broadcast(spark.createDataFrame([(g, *(round(w * 1e6) for w in ws)) for g, ws in model["weights"].items()], "gram string, " + ", ".join(f"w{i} long" for i in range(len(families)))))
    pairs = F.broadcast(spark.createDataFrame(template_rows, "said string, template int, gram string, pairs int, pair_own int"))
    rows = paragraphs(docs)
    if gate is not None and min(gate[1]) >= 0 and gate[0]:
        rows = _near(rows, *gate)
    # numbered once, so that rows of one doc_id or of none stay apart
    rows = stash(rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "paragraph", "tokens"), "licence-paragraphs")
    sums = _exploded(rows, "uid").join(weights, "gram").groupBy("uid").agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(families))])
    # millionths, so that sums do not depend on their order
    logits = [(F.coalesce(f"w{i}", F.lit(0)) + F.lit(round(b * 1e6))) / F.lit(1e6) for i, b in enumerate(model["bias"])]
    ranked = rows.join(sums, "uid", "left").withColumn("z", F.array(*[F.struct(F.round(z, 6).alias("z"), F.lit(-i).alias("i"), F.lit(f).alias("said")) for i, (z, f) in enumerate(zip(logits, families))]))
    best = ranked.withColumn("best", F.array_max("z")).where(F.col("best.said") != UNKNOWN)
    said = stash(
        best.select("uid", "doc_id", "paragraph", "tokens", "best.said", F.round(1 / F.aggregate("z", F.lit(0.0), lambda acc, x: acc + F.exp(x["z"] - F.col("best.z"))), 6).alias("probability")),
        "licence-said",
    )
    own = said.select("uid", "said", F.array_distinct(_grams(2)).alias("own"))
    shared = own.select("uid", "said", F.size("own").alias("size"), F.explode("own").alias("gram")).join(pairs, ["said", "gram"]).groupBy("uid", "template", "pairs", "size").agg(F.count(F.lit(1)).alias("n"), F.max("pair_own").alias("own"))
    share = F.when(F.col("own") == 1, F.greatest(F.col("n") / F.col("pairs"), F.when(F.col("n") >= MIN_SHARED, F.col("n") / F.col("size")))).otherwise(0.0)
    held = shared.groupBy("uid").agg(F.round(F.max(share), 6).alias("contained"))
    joined = said.join(held, "uid", "left").withColumn("contained", F.coalesce("contained", F.lit(0.0)))
    confirmed = (F.col("probability") >= model["threshold"]) & (F.col("contained") >= min_contained)
    return joined.select(
        "doc_id", F.col("paragraph").cast("long").alias("paragraph"), "said", "probability", "contained", confirmed.alias("confirmed"),
        F.when(confirmed, F.col("said")).otherwise(UNKNOWN).alias("family"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    negatives, uses = negatives_of(docs)
    model = train(negatives)
    return scan(docs, model, word_bounds(model, uses))
