"""Personal data: exact base patterns, then a skip-chain conditional random field that adds consistent mentions.

Base spans come from the stated patterns. The field's nodes are the white-space tokens of a document that hold a digit
or an at sign, the only ones that any kind can label; their states are the four kinds and "none". Node potentials are a
softmax over character-shape features; neighbouring nodes with no word between share chain potentials. Both are trained here
by pseudo-likelihood on tokens that the base patterns label (distant supervision on a bounded sample of documents). Tokens
whose cleaned forms are equal, or that share their digits or their e-mail user, are joined through a hub per form: the skip
chains, linear in the number of mentions. How strongly a hub of each sort binds its nodes is learnt on the same sample, from how often
nodes of a hub have its commonest label. A number split over several tokens is a node of its own if it repeats a base mention;
numbers are the same if their digits are, leading zeros (trunk 0, 00) left out, or if one lacks the other's country code, of up to
three digits. Loopy sum-product passes over nodes, chains and hubs spread the clamped base labels. What lies outside the base
spans becomes a span if its kind's belief reaches ADD, an equal or similar mention in the same document has that
kind, and its own form admits the kind.

A second field then judges mentions that no pattern takes: numbers without a country code, masked numbers and addresses (****1234,
j***@x.org) and written-out addresses (john at x.org). Its nodes are the spans known so far, clamped, and these candidates. Node potentials
come from form and the words before; they are trained on base mentions with what gives them away removed, against the same forms
behind nothing (two to one none) or behind words from elsewhere, so that a form alone is not enough. Chains link mentions with no more than a comma or a
conjunction between them, with potentials counted on such pairs; skip chains link equal numbers and addresses and masked ones with
what they can stand for. A candidate becomes a span if its kind's belief reaches ADD.

Rules for odd input: null text counts as empty; texts without nodes are done at once; very long texts are worked
through whole, in time and memory linear in their length and nodes; of equally likely kinds the first as listed stands; a null doc_id
stays null; repeated rows give equal results; an empty table gives no rows; extra columns, also of clashing names, are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stash, least_hashes, new_path

KINDS = ("email", "ip", "card", "phone")
NONE = 4
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match begins and ends with a whole run of digits, so each run is walked through once.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DIGIT, NODE_SIGN, TOKEN = re.compile("[0-9]"), re.compile("[0-9@]"), re.compile(r"\S+")
#: Training documents (those with the least seeded hash among documents with nodes), training tokens, belief to add a span.
TRAIN_DOCS, TRAIN_TOKENS, SEED, ADD = 4_000, 60_000, 29, 0.9
PASSES = 6
#: Kinds of hubs by the first letter of their form: equal form, equal digits, equal e-mail user. COUPLING stands in where nothing was learnt.
HUBS, COUPLING = "fdu", 3.0
#: Digits that a number must share with another one to be the same.
LEAST_DIGITS = 7
TRIM = "\"'()[]{}<>,;:!?"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """EMAIL's leftmost non-overlapping matches, found from each at sign: its local part is the run before it."""
    least, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > least and LOCAL.match(text[start - 1]):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m.span()
            least = m.end()
        at = text.find("@", max(at + 1, least))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind as listed, then start."""
    out = [(0, *s) for s in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        if text.count(".") >= 3:
            out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return out


def nodes_of(text: str) -> list[tuple[int, int]]:
    """Spans of white-space tokens with a digit or an at sign, without the punctuation around them."""
    out, end = [], 0
    for m in NODE_SIGN.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        found = TOKEN.match(text, start)
        end = found.end()
        a, b = start, end
        while a < b and text[a] in TRIM:
            a += 1
        while b > a and text[b - 1] in TRIM + ".":
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def shape(token: str) -> list[str]:
    digits = sum("0" <= c <= "9" for c in token)
    user, at, host = token.partition("@")
    return [
        "bias",
        f"at{min(token.count('@'), 2)}",
        f"dots{min(token.count('.'), 4)}",
        f"host_dot{int('.' in host)}" if at else "no_host",
        f"user{int(bool(user))}" if at else "no_user",
        f"digits{min(digits, 20)}",
        f"all_digits{int(digits == len(token))}",
        f"plus{int(token[:1] == '+')}",
        f"hyphens{min(token.count('-'), 3)}",
        f"letters{int(any(c.isalpha() for c in token))}",
        f"groups{min(len(re.findall('[0-9]+', token)), 5)}",
        f"group_size{max(map(len, re.findall('[0-9]+', token)), default=0)}",
    ]


def admits(token: str, kind: int) -> bool:
    """Whether a token's own form can be a mention of the kind."""
    digits = re.sub("[^0-9]", "", token)
    if kind == 0:
        return "@" in token and len(token) >= 4
    if "@" in token or any(c.isalpha() for c in token):
        return False
    return (7 <= len(digits) <= 12 and token.count(".") == 3, 12 <= len(digits) <= 19, 9 <= len(digits) <= 15)[kind - 1]


def forms(token: str) -> list[str]:
    """Hubs a token belongs to: its folded form, its digits, its e-mail user."""
    digits = re.sub("[^0-9]", "", token)
    out = ["f" + token.casefold()]
    if len(digits) >= 7 and "@" not in token:
        out.append("d" + digits[-10:])
    if "@" in token and len(token.partition("@")[0]) >= 3:
        out.append("u" + token.partition("@")[0].casefold())
    return out


def numbers_of(kind: int, text: str) -> list[str]:
    """Digits under which a base card or phone can be repeated: leading zeros left out, and for phones the country code (with a trunk 0)."""
    digits = re.sub("[^0-9]", "", text)
    found = {digits} if kind == 2 else {d[j:] for d in (digits, re.sub("[^0-9]", "", text.replace("(0)", ""))) for j in range(4)}
    return sorted({d for d in (d.lstrip("0") for d in found) if len(d) >= LEAST_DIGITS})


def number_runs(text: str, nodes: list[tuple[int, int]], labels: list[int], known: dict[str, int]) -> list[tuple[int, int, str]]:
    """(first node, last node, digits) of neighbouring unlabelled nodes, one or more, that together repeat a known number; longest first."""
    out = []
    for i in range(len(nodes)):
        digits = ""
        for j in range(i, len(nodes)):
            a, b = nodes[j]
            if labels[j] != NONE or (j > i and not near(text, nodes[j - 1], nodes[j])) or "@" in text[a:b] or any(c.isalpha() for c in text[a:b]):
                break
            digits += re.sub("[^0-9]", "", text[a:b])
            if len(digits) > 24:
                break
            if digits.lstrip("0") in known:
                out.append((i, j, digits.lstrip("0")))
    return sorted(out, key=lambda r: (r[0] - r[1], r[0]))


def near(text: str, left: tuple[int, int], right: tuple[int, int]) -> bool:
    """Whether only blanks and punctuation lie between two nodes."""
    between = text[left[1] : right[0]]
    return len(between) <= 8 and not any(c.isalnum() for c in between)


def chain_of(weights: dict[str, list[float]]) -> np.ndarray:
    """Chain log-potentials (left kind x right kind): the mean of what the left and the right neighbour's kind were worth in training."""
    nothing = [0.0] * (NONE + 1)
    after = np.array([weights.get(f"before{k}", nothing) for k in range(NONE + 1)])
    before = np.array([weights.get(f"after{k}", nothing) for k in range(NONE + 1)])
    return (after + before.T) / 2


def labels_of(nodes: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """Per node the first kind of which a base span overlaps it, or NONE. Spans of a kind are sorted and apart."""
    spans = [(k, [s for j, s, _ in base if j == k], [e for j, _, e in base if j == k]) for k in sorted({k for k, _, _ in base})]

    def label(a: int, b: int) -> int:
        for k, starts, ends in spans:
            i = bisect_right(ends, a)
            if i < len(starts) and starts[i] < b:
                return k
        return NONE

    return [label(a, b) for a, b in nodes]


def fit_shapes(examples: list[tuple[list[str], int]], momentum: bool = False) -> dict[str, list[float]]:
    """Softmax regression with L2: feature -> five log-potentials. With momentum steps gather speed, which rare features need."""
    if not examples:
        return {}
    names = sorted({f for x, _ in examples for f in x})
    where = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(examples), len(names)))
    for i, (features, _) in enumerate(examples):
        x[i, [where[f] for f in features]] = 1
    y = np.eye(NONE + 1)[[k for _, k in examples]]
    w = np.zeros((len(names), NONE + 1))
    step = 4 / (x.sum(1).mean())
    look = w
    for n in range(300):
        z = x @ look
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        new = look - step * (x.T @ (p - y) / len(x) + 1e-4 * look)
        look, w = new + (n / (n + 3) * (new - w) if momentum else 0), new
    return {f: [round(v, 9) for v in w[i]] for f, i in where.items()}


def hub_counts(tokens: list[str], labels: list[int]) -> list[tuple[str, int, int]]:
    """(sort of hub, its nodes, those with its commonest label) over the hubs of a document with a labelled node."""
    members: dict[str, list[int]] = {}
    for t, k in zip(tokens, labels):
        for f in forms(t):
            members.setdefault(f, []).append(k)
    found = {sort: [0, 0] for sort in HUBS}
    for f, kinds in members.items():
        if len(kinds) > 1 and min(kinds) < NONE:
            found[f[0]][0] += len(kinds)
            found[f[0]][1] += max(map(kinds.count, set(kinds)))
    return [(sort, n, m) for sort, (n, m) in found.items() if n]


def coupling_of(nodes: int, agreeing: int) -> float:
    """Log-odds of a hub's label against each other one, from how many nodes agree with it (one more of either kind is added)."""
    share = (agreeing + 1) / (nodes + 2)
    return max(0.0, math.log(share * NONE / (1 - share)))


def beliefs(unary: np.ndarray, hubs: list[list[int]], coupling: float | list[float] = COUPLING, passes: int = PASSES, edges: list[tuple[int, int]] = (), chain: np.ndarray | None = None) -> np.ndarray:
    """Loopy sum-product on nodes, hubs and chains: each hub is a hidden label that its nodes share with odds exp(coupling), one for all
    hubs or one for each; nodes of an edge (left, right) share the chain's log-potentials.

    unary: log-potentials (nodes x states). Work is linear in the links between nodes and hubs and in the edges."""
    links = [(t, h) for h, ts in enumerate(hubs) for t in ts]
    states = unary.shape[1]
    token, hub = (np.array([x[i] for x in links], np.int64) for i in (0, 1))
    stay = np.exp(np.broadcast_to(np.asarray(coupling, float), len(hubs)))[hub][:, None]
    # every edge in both directions: messages from source to target, and the place of the opposite one
    source, target = (np.array([e[i] for e in edges] + [e[1 - i] for e in edges], np.int64) for i in (0, 1))
    opposite = np.roll(np.arange(2 * len(edges)), len(edges))
    potentials = np.stack([chain] * len(edges) + [chain.T] * len(edges)) if len(edges) else np.zeros((0, states, states))

    def scaled(m: np.ndarray) -> np.ndarray:
        p = np.exp(m - m.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def across(m: np.ndarray) -> np.ndarray:
        p = scaled(m)
        p = p.sum(1, keepdims=True) + (stay - 1.0) * p
        return np.log(p / p.sum(1, keepdims=True))

    down, side = np.zeros((len(links), states)), np.zeros((2 * len(edges), states))
    for _ in range(passes if len(links) or len(edges) else 0):
        total = unary.copy()
        np.add.at(total, token, down)
        np.add.at(total, target, side)
        up = across(total[token] - down)
        heard = np.zeros((len(hubs), states))
        np.add.at(heard, hub, up)
        down = across(np.clip(heard[hub] - up, -60, 60))
        z = (total[source] - side[opposite])[:, :, None] + potentials
        top = z.max(1, keepdims=True)
        side = (np.log(np.exp(z - top).sum(1, keepdims=True)) + top)[:, 0]
        side = side - side.max(1, keepdims=True) if len(edges) else side
    total = unary.copy()
    np.add.at(total, token, down)
    np.add.at(total, target, side)
    return scaled(total)


def added_spans(text: str, base: list[tuple[int, int, int]], weights: dict[str, list[float]], add: float = ADD) -> list[tuple[int, int, int]]:
    """Spans that the field adds to the base spans of one document."""
    if not base or not weights:
        return []  # without a base mention nothing in the document can be consistent with one
    nodes = nodes_of(text)
    labels = labels_of(nodes, base)
    if NONE not in labels:
        return []
    tokens = [text[a:b] for a, b in nodes]
    members: dict[str, list[int]] = {}
    for i, t in enumerate(tokens):
        for f in forms(t):
            members.setdefault(f, []).append(i)
    unary = np.zeros((len(nodes), NONE + 1))
    for i, (t, k) in enumerate(zip(tokens, labels)):
        unary[i] = _pinned(k) if k < NONE else _potentials(t, weights)
    # a mention split by blanks is one base span: its digits make a hub that a repetition, split or not, can join
    extra, known = [], {}
    for k, s, e in base:
        digits = re.sub("[^0-9]", "", text[s:e])
        if k in (2, 3):
            if f"d{digits[-10:]}" in members and len(digits) >= 7:
                extra.append((k, f"d{digits[-10:]}"))
            for number in numbers_of(k, text[s:e]):
                known.setdefault(number, k)
    for j, (k, f) in enumerate(extra):
        members[f].append(len(nodes) + j)
    kind_of, spans = labels + [k for k, _ in extra], nodes + [None] * len(extra)
    rows, edges = [_pinned(k) for k, _ in extra], [(i, i + 1) for i in range(len(nodes) - 1) if near(text, nodes[i], nodes[i + 1])]
    joined = set(edges)
    named = [(f, ts) for f, ts in members.items() if len(ts) > 1]
    hubs, coupling = [ts for _, ts in named], [weights.get(f"hub {f[0]}", [COUPLING])[0] for f, _ in named]
    first, pins, covers = len(hubs), {}, {}
    for i, j, number in number_runs(text, nodes, labels, known) if known else []:
        if number not in pins:  # one clamped node and one hub per number
            kind_of.append(known[number])
            spans.append(None)
            rows.append(_pinned(known[number]))
            pins[number] = len(hubs)
            hubs.append([len(spans) - 1])
            # a chance match of its digits has odds of 1 to 10 ** digits
            coupling.append(min(len(number), 15) * math.log(10))
        if i == j:
            hubs[pins[number]].append(i)
            continue
        a, b = nodes[i][0], nodes[j][1]
        spans.append((a - (text[a - 1 : a] == "(" and ")" in text[a:b]), b))
        covers[len(spans) - 1] = range(i, j + 1)
        kind_of.append(NONE)
        rows.append(_potentials("".join(text[a:b].split()), weights))
        hubs[pins[number]].append(len(spans) - 1)
        edges += [(i - 1, len(spans) - 1)] * ((i - 1, i) in joined) + [(len(spans) - 1, j + 1)] * ((j, j + 1) in joined)
    if not hubs:
        return []
    p = beliefs(np.vstack([unary, *rows]), hubs, coupling, edges=edges, chain=chain_of(weights))
    support, same = [set() for _ in spans], [0] * len(spans)
    for h, ts in enumerate(hubs):
        kinds = {kind_of[t] for t in ts} - {NONE}
        for t in ts:
            support[t] |= kinds
            if h >= first:
                same[t] = 1
    out, taken = [], set()
    # numbers of several nodes come first, the longest before the others
    for i in [*range(len(nodes) + len(extra), len(spans)), *range(len(nodes))]:
        if kind_of[i] == NONE and spans[i]:
            (a, b), k = spans[i], int(p[i, :NONE].argmax())
            if p[i, k] >= add and k in support[i] and (admits("".join(text[a:b].split()), k) or same[i] and k in (2, 3)):
                held = covers.get(i, range(i, i + 1))
                if taken.isdisjoint(held):
                    out.append((k, a, b))
                    taken.update(held)
    return out


NUMBER = re.compile(r"(?<![\w+@.,*/-])\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,14}(?![\w@*])(?![.,/-][0-9])")
MASKED = re.compile(r"(?<![\w*•])(?:[*•xX]{2,8}[\x20-]?){1,5}[0-9]{2,4}(?![\w*•@])")
MASKED_ADDRESS = re.compile(r"(?<![\w*•.])[A-Za-z0-9][*•]{2,12}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,4}")
AT_SIGN = re.compile(r"\x20?[(\[]at[)\]]\x20?|\x20(?:at|AT)\x20")
HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]{2,63}){1,4}(?![\w@])")
USER = re.compile(r"(?<![\w.%+@-])[A-Za-z0-9][A-Za-z0-9._%+-]{1,63}$")
LINKED = re.compile(r"[\s,;/|]{0,4}(?:(?:and|or|und|oder|et|ou)\s{1,2})?")
CONTEXT_WORD = re.compile(r"[^\W\d_]+")
#: Kinds that each sort of candidate can be.
SORTS = {"number": (3,), "masked": (2, 3), "address": (0,)}
#: Negative copies of a hidden mention behind words from elsewhere; characters looked at before a candidate; uses from which on a context word counts.
ELSEWHERE, LOOK_BACK, LEAST_USES, PRIOR_PAIRS = 3, 40, 5, 10
#: Mentions, and candidates, of one document that the second field learns from.
MOST_SPANS = 40


def candidates(text: str, known: list[tuple[int, int, int]]) -> list[tuple[str, int, int, str]]:
    """(sort, start, end, form) of what may be a mention and overlaps no known span, in order."""
    found = []
    if DIGIT.search(text):
        found += [("number", *m.span(), re.sub("[^0-9]", "", m.group())) for m in NUMBER.finditer(text)]
        found += [("masked", *m.span(), re.sub("[^0-9]", "", m.group())) for m in MASKED.finditer(text)]
    if "@" in text:
        found += [("address", *m.span(), m.group()[0].casefold() + "*@" + m.group().partition("@")[2].casefold()) for m in MASKED_ADDRESS.finditer(text)]
    for m in AT_SIGN.finditer(text):
        host, user = HOST.match(text, m.end()), USER.search(text[max(0, m.start() - 66) : m.start()])
        if host and user:
            form = f"{user.group()}@{re.sub(' ?[(\\[]dot[)\\]] ?| dot ', '.', host.group())}".casefold()
            found.append(("address", m.start() - len(user.group()), host.end(), form))
    spans = sorted((s, e) for _, s, e in known)
    starts, out, end = [s for s, _ in spans], [], 0
    ends = list(itertools.accumulate((e for _, e in spans), max))
    for sort, a, b, form in sorted(found, key=lambda c: (c[1], -c[2])):
        i = bisect_right(starts, b - 1)  # spans that begin before b
        if a >= end and (not i or ends[i - 1] <= a):
            out.append((sort, a, b, form))
            end = b
    return out


def context(text: str, at: int) -> list[str]:
    """Features of up to three words that end shortly before a place."""
    begin = max(0, at - LOOK_BACK)
    words = [m.group().casefold() for m in CONTEXT_WORD.finditer(text, begin, at) if m.start() > begin or not begin]
    return [f"near {w}" for w in dict.fromkeys(words[-3:])] + [f"last {w}" for w in words[-1:]]


def candidate_shape(sort: str, text: str) -> list[str]:
    digits = sum("0" <= c <= "9" for c in text)
    return [f"sort {sort}", f"{sort} digits {min(digits, 16)}", f"{sort} groups {min(len(re.findall('[0-9]+', text)), 5)}", f"{sort} marks {min(sum(c in '()./-' for c in text), 3)}"]


def hidden(kind: int, text: str) -> tuple[str, str] | None:
    """(sort, text) of a base mention without what gives it away, or None."""
    if kind == 0:
        return "address", text.replace("@", " at ")
    if kind == 2:
        return "masked", "****" + re.sub("[^0-9]", "", text)[-4:]
    if kind == 3:
        bare = re.sub(r"^\+[0-9]{1,3}[\x20.-]*", "", text)
        return ("number", bare) if sum("0" <= c <= "9" for c in bare) >= LEAST_DIGITS else None
    return None


def linked(text: str, left: tuple[int, int], right: tuple[int, int]) -> bool:
    """Whether no more than a comma or a conjunction lies between two spans."""
    return 0 <= right[0] - left[1] <= 12 and LINKED.fullmatch(text, left[1], right[0]) is not None


def _known_forms(kind: int, text: str) -> list[str]:
    """Hubs of a known span that candidates can join."""
    if kind == 0:
        user, _, host = text.casefold().partition("@")
        return [f"a{user}@{host}", f"a{user[:1]}*@{host}"]
    digits = re.sub("[^0-9]", "", text)
    return [f"m{digits[-n:]}" for n in (2, 3, 4)] + [f"n{d}" for d in numbers_of(kind, text)] if kind in (2, 3) else []


def _candidate_forms(sort: str, form: str) -> list[tuple[str, float]]:
    """(hub, coupling): a chance match of so many digits has odds of 1 to 10 ** digits."""
    if sort == "address":
        return [(f"a{form}", 9.0 if "*@" in form else 12.0)]
    if sort == "masked":
        return [(f"m{form}", len(form) * math.log(10))]
    return [(f"n{form.lstrip('0')}", min(len(form), 15) * math.log(10))]


def context_spans(text: str, known: list[tuple[int, int, int]], weights: dict, add: float = ADD, chains: bool = True, hubs: bool = True) -> list[tuple[int, int, int]]:
    """Spans of the second field; chains and hubs can be left out, for comparison."""
    if not any(name.startswith("sort ") for name in weights):
        return []
    found = candidates(text, known)
    if not found:
        return []
    # known spans far from every candidate change nothing but through hubs
    nodes = sorted([(s, e, k, "", "") for k, s, e in known] + [(a, b, NONE, sort, form) for sort, a, b, form in found])
    unary, groups = np.zeros((len(nodes), NONE + 1)), {}
    for i, (a, b, k, sort, form) in enumerate(nodes):
        if sort:
            unary[i] = np.sum([np.zeros(NONE + 1), *(weights[f] for f in candidate_shape(sort, text[a:b]) + context(text, a) if f in weights)], axis=0)
            # what speaks for a kind that this sort cannot be speaks for none
            other = [j for j in range(NONE) if j not in SORTS[sort]]
            unary[i, NONE] = np.logaddexp.reduce(unary[i, [*other, NONE]])
            unary[i, other] = -30.0
            for f, c in _candidate_forms(sort, form):
                groups.setdefault(f, ([], []))
                groups[f][0].append(i)
                groups[f][1].append(c)
        else:
            unary[i] = _pinned(k)
    if hubs:
        for i, (a, b, k, sort, _) in enumerate(nodes):
            if not sort:
                for f in _known_forms(k, text[a:b]):
                    if f in groups:
                        groups[f][0].append(i)
    named = [(ts, max(cs)) for ts, cs in groups.values() if len(ts) > 1] if hubs else []
    edges = [(i, i + 1) for i in range(len(nodes) - 1) if (nodes[i][3] or nodes[i + 1][3]) and linked(text, nodes[i][:2], nodes[i + 1][:2])] if chains else []
    chain = np.array([weights.get(f"pair {k}", [0.0] * (NONE + 1)) for k in range(NONE + 1)])
    p = beliefs(unary, [ts for ts, _ in named], [c for _, c in named], 2 * PASSES, edges, chain)
    out = []
    for i, (a, b, _, sort, _) in enumerate(nodes):
        k = int(p[i, :NONE].argmax())
        if sort and k in SORTS[sort] and p[i, k] >= add:
            out.append((k, a, b))
    return out


def _spread(spans: list) -> list:
    """At most MOST_SPANS of them, evenly over the text."""
    return spans[:: max(1, -(-len(spans) // MOST_SPANS))]


def _context_examples(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int, int, str]]:
    """Rows (features, kind, -1, -1, sort of row): hidden base mentions, the same behind other words or none, and candidates that are none; and
    how often kinds of spans and of linked pairs occur."""
    found, begins = candidates(text, base), sorted(a for _, a, _ in base)
    for sort, a, b, _ in _spread(found):
        yield "\t".join(candidate_shape(sort, text[a:b]) + context(text, a)), NONE, -1, -1, "candidate"
    for n, (k, a, b) in enumerate(_spread(base)):
        form = hidden(k, text[a:b])
        if form:
            shape_of = candidate_shape(*form)
            yield "\t".join(shape_of + context(text, a)), k, -1, -1, "candidate"
            for label in (k, NONE, NONE):  # behind nothing a form says little
                yield "\t".join(shape_of), label, -1, -1, "candidate"
            for j in range(ELSEWHERE):
                at = (a + (2 * j + n + 1) * len(text) // 7) % max(len(text), 1)
                i = bisect_right(begins, at - 2 * LOOK_BACK)
                if i == len(begins) or begins[i] > at + 2 * LOOK_BACK:  # far from what announces a mention
                    yield "\t".join(shape_of + context(text, at)), NONE, -1, -1, "candidate"
    spans = sorted([(a, b, k) for k, a, b in base] + [(a, b, NONE) for _, a, b, _ in found])
    pairs = Counter((k, -1) for _, _, k in spans)
    pairs.update((left[2], right[2]) for left, right in zip(spans, spans[1:]) if linked(text, left[:2], right[:2]))
    for (left, right), times in sorted(pairs.items()):
        yield str(times), -1, left, right, "pair"


def fit_context(examples: list[tuple[list[str], int]], pairs: list[tuple[int, int, int]]) -> dict[str, list[float]]:
    """Potentials of the second field: of forms and context words; and log-odds of the kinds of linked spans against those of spans at large
    (pairs whose right kind is -1), with PRIOR_PAIRS of the latter added."""
    uses = Counter(f for x, _ in examples for f in x)
    weights = fit_shapes([([f for f in x if uses[f] >= LEAST_USES], k) for x, k in examples], momentum=True)
    table, alone = np.zeros((NONE + 1, NONE + 1)), np.ones(NONE + 1)
    for left, right, n in pairs:
        if right < 0:
            alone[left] += n
        else:
            table[left, right] += n
    free = np.outer(alone, alone) / alone.sum() ** 2
    odds = np.log((table + PRIOR_PAIRS * free) / (table.sum() + PRIOR_PAIRS) / free)
    return weights | {f"pair {k}": [round(float(v), 9) for v in odds[k]] for k in range(NONE + 1)} if weights else {}


def _pinned(kind: int) -> np.ndarray:
    return np.where(np.arange(NONE + 1) == kind, 0.0, -30.0)


def _potentials(token: str, weights: dict[str, list[float]]) -> np.ndarray:
    return np.sum([np.zeros(NONE + 1), *(weights[f] for f in shape(token) if f in weights)], axis=0)


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _examples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of nodes (token, kind, kinds of its neighbours, -1 without one), and rows of hubs: (sort, -1, nodes, agreeing nodes)."""
    for batch in batches:
        tokens, kinds, befores, afters, sorts = [], [], [], [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            nodes = nodes_of(text)
            labels = labels_of(nodes, base)
            linked = [near(text, a, b) for a, b in zip(nodes, nodes[1:])]
            words = [text[a:b] for a, b in nodes]
            tokens += [w[:200] for w in words]
            kinds += labels
            befores += [-1] * bool(nodes) + [k if x else -1 for k, x in zip(labels, linked)]
            afters += [k if x else -1 for k, x in zip(labels[1:], linked)] + [-1] * bool(nodes)
            for sort, n, m in hub_counts(words, labels):
                for column, value in zip((tokens, kinds, befores, afters), (sort, -1, n, m)):
                    column.append(value)
            sorts += ["node"] * (len(tokens) - len(sorts))
            for row in _context_examples(text, base):
                for column, value in zip((tokens, kinds, befores, afters, sorts), row):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens, pa.string()), *(pa.array(x, pa.int32()) for x in (kinds, befores, afters)), pa.array(sorts, pa.string())], names=["token", "kind", "before", "after", "sort"]
        )


def train(docs: DataFrame, docs_bound: int = TRAIN_DOCS) -> dict[str, list[float]]:
    """Shape and chain potentials and couplings from a bounded sample of documents; labels are the base patterns' own."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    some = least_hashes(rows.where(F.col("text").rlike("[0-9@]")).select("doc_id"), docs.count(), F.xxhash64("doc_id", F.lit(SEED)), ["doc_id"], docs_bound)
    texts = rows.where(F.col("text").isNotNull()).join(F.broadcast(some), "doc_id", "left_semi")
    spark, schema, path = docs.sparkSession, "token string, kind int, before int, after int, sort string", new_path(docs.sparkSession, "personal-examples")
    texts.mapInArrow(_examples, schema).write.parquet(path)
    found = spark.read.schema(schema).parquet(path)

    def chosen(sort: str) -> list:
        return found.where((F.col("kind") >= 0) & (F.col("sort") == sort)).orderBy(F.xxhash64("token", "kind"), "token", "kind", "before", "after").limit(TRAIN_TOKENS).collect()

    counted = chosen("node")
    weights = fit_shapes([(shape(r.token) + [f"before{r.before}"] * (r.before >= 0) + [f"after{r.after}"] * (r.after >= 0), r.kind) for r in counted])
    pairs = found.where("sort = 'pair'").groupBy("before", "after").agg(F.sum(F.col("token").cast("long")).alias("n")).collect()  # one row per pair of kinds
    second = fit_context([(r.token.split("\t"), r.kind) for r in chosen("candidate")], [(r.before, r.after, r.n) for r in pairs])
    hubs = found.where("kind < 0 AND sort = 'node'").groupBy("token").agg(F.sum("before").alias("nodes"), F.sum("after").alias("agreeing")).collect()  # one row per sort
    drop_stash(spark, path)
    return weights | {f"hub {r.token}": [coupling_of(r.nodes, r.agreeing)] for r in hubs} | second if weights else {}


def _find(batches: Iterable[pa.RecordBatch], weights: dict[str, list[float]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, sums, spans = [], [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            base = base_spans(text)
            found = base + added_spans(text, base, weights)
            found += context_spans(text, found, weights)
            counts.append([sum(k == kind for k, _, _ in base) for kind in range(NONE)])
            sums.append(hashlib.sha256(digest(base).encode()).hexdigest())
            spans.append(digest(found))
        columns = np.array(counts, np.int64).reshape(-1, NONE)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(columns[:, k]) for k in range(NONE)), pa.array(sums, pa.string()), pa.array(spans, pa.string())],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
        )


def find_personal_data(docs: DataFrame, weights: dict[str, list[float]]) -> DataFrame:
    """Per row: doc_id, base counts n_email, n_ip, n_card, n_phone, base_sha256, spans (base and added)."""
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_find, weights=weights), schema)


def redact(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    marks = sorted(((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x)), reverse=True)
    last = len(text)
    for s, e, k in marks:
        if e <= last:
            text, last = f"{text[:s]}<{k}>{text[e:]}", s
    return text


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_personal_data(docs, train(docs))
