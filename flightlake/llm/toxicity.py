"""Toxicity: a subsequence string-kernel SVM with Nyström landmarks.

Two strings are alike as far as they share subsequences of three characters,
each occurrence discounted by the length of its span: inserted characters,
gaps and endings change little. A sentence is read in units: its tokens, runs of
single characters put together, windows of short neighbouring tokens with the
blanks as gaps, and windows of text without blanks. It is as toxic as its worst
unit.

The kernel is not evaluated against landmarks when scoring. With landmarks l,
the Nyström features are z(u) = K_ll^(-1/2) k(u, l) and the SVM's margin
w . z(u) is a sum over the subsequences of u with one weight each, kept in a
table over the landmarks' alphabet. Each task scores a distinct unit once.

One task fits the model on a bounded sample of labelled documents. Only some
sentences of a toxic document are toxic: its worst units stand for it and are
chosen anew in each round, while every unit of a clean document is clean.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import held_out, without
from flightlake.llm.decontam import chunks
from flightlake.llm.quality import labelled_texts, sample_labels

#: Labelled documents that a fit uses at most (those with the smallest id hashes).
MAX_TRAIN = 6_000
DECAY = 0.6
LANDMARKS = 192
ROUNDS = 4
#: Clean units that a round of the fit uses, telling units that may be landmarks,
#: common clean units among which the most confusing ones become landmarks.
MAX_NEGATIVES, TELLING, COMMON = 20_000, 1_000, 4_000
#: Likelihood ratio at which a unit's use alone marks it as toxic at first.
EVIDENCE = 12.0
#: Units of a document that its score may rest on.
WORST = 8
#: How many times as likely in toxic documents a toxic unit is at least.
ODDS = 10.0
THRESHOLD = 0.7
#: A longer unit (text without blanks) is read in windows of so many characters, at every so many.
PIECE, WINDOW, STEP = 20, 10, 3
#: Characters of a short token, of neighbouring ones that are read as one, and
#: of the beginning by which these are chosen.
SHORT, JOINED, START = 5, 12, 4
#: Lengths of the strings inside long units that are looked at as units.
INNER = (4, 5, 6, 7)
#: Distinct units whose scores a task keeps.
CACHE = 300_000

_EDGES = "\"'.,;:!?()[]{}<>*#$%&|_-~`/\\…“”„»«"
_START = "^"


def units(text: str | None) -> list[str]:
    """Lower-case tokens, without signs at their ends; runs of three or more
    single characters ("i d i o t") also count as one unit."""
    text = (text or "").lower()
    for sign in (". ", ", ", ".\n", ",\n", "! ", "? "):  # fewer distinct tokens
        text = text.replace(sign, " ")
    tokens = text.split()
    if len(tokens) < 3:
        return tokens
    single = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) == 1
    starts = np.flatnonzero(single[:-2] & single[1:-1] & single[2:])
    if len(starts):
        joined, done = [], 0
        for at in starts.tolist():
            if at < done:
                continue
            done = at
            while done < len(tokens) and single[done]:
                done += 1
            joined.append("".join(tokens[at:done]))
        tokens = tokens + joined
    return tokens


def windows(tokens: list[str], starts: frozenset[str]) -> list[str]:
    """Two or three neighbouring short tokens as one unit, the blanks between
    them gaps of the kernel: an insult that was taken apart ("id iot") is one unit
    again. Only those whose letters begin like a telling unit are scored."""
    out = []
    a = b = ""  # the token before, and the one before that ("" where it is too long)
    for t in tokens:
        if len(t) > SHORT:
            a = b = ""
            continue
        if a:
            two = a + t
            if two[:START] in starts and len(two) <= JOINED:
                out.append(a + " " + t)
            if b and (b + two)[:START] in starts and len(b) + len(two) <= JOINED:
                out.append(b + " " + a + " " + t)
        a, b = t, a
    return out


def pieces(unit: str) -> list[str]:
    """What the kernel sees of a unit: its start mark and characters; where
    signs stand inside ("i.d.i.o.t"), also the unit without them."""
    core = unit.strip(_EDGES)
    found = _cut(core)
    if " " not in core and not core.isalnum():
        plain = "".join(filter(str.isalnum, core))
        if 1 < len(plain) < len(core):
            found += _cut(plain)
    return found


def _cut(core: str) -> list[str]:
    if len(core) <= PIECE:
        return [_START + core] if len(core) > 1 else []
    last = len(core) - WINDOW
    return [core[i:i + WINDOW] for i in [*range(0, last, STEP), last]]


#: Positions and discounts of subsequences, by length of the string.
_TRIPLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all subsequences of three characters and their discounts."""
    if length not in _TRIPLES:
        at = np.array(list(combinations(range(length), 3)), dtype=np.int64).reshape(-1, 3)
        _TRIPLES[length] = at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)
    return _TRIPLES[length]


def _by_length(strings: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, numbers of the strings of that length, their code points)."""
    lengths = np.array([len(s) for s in strings])
    for n in np.unique(lengths).tolist():
        which = np.flatnonzero(lengths == n)
        for at in range(0, len(which), 2_000):
            some = which[at:at + 2_000]
            data = "".join(strings[i] for i in some).encode("utf-32-le", "surrogatepass")
            yield n, some, np.frombuffer(data, np.uint32).reshape(len(some), n).astype(np.int64)


def self_kernel(codes: np.ndarray) -> np.ndarray:
    """K(u, u) for strings of equal length: the gap-weighted recursion, over
    all strings at once for each pair of positions."""
    count, n = codes.shape
    columns = np.ascontiguousarray(codes.T)
    match = [[np.where(columns[i] == columns[j], DECAY * DECAY, 0.0) for j in range(i + 1)] for i in range(n)]
    match = [[match[max(i, j)][min(i, j)] for j in range(n)] for i in range(n)]
    inner = np.ones((n + 1, n + 1, count))
    for _ in range(2):
        following = np.zeros((n + 1, n + 1, count))
        for i in range(n):
            run = np.zeros(count)
            for j in range(n):
                run = DECAY * run + match[i][j] * inner[i, j]
                following[i + 1, j + 1] = DECAY * following[i, j + 1] + run
        inner = following
    total = np.zeros(count)
    for i in range(n):
        for j in range(n):
            total += match[i][j] * inner[i, j]
    return total


def _scatter(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(34)).astype(np.int64)


def _hash_table(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open table of (key, column 1, 2, ...) with four places a key, whatever the
    alphabet; a key of 0 is an empty place."""
    size = 1 << max(4, (4 * len(keys)).bit_length())
    table, columns = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int32)
    for column, (key, slot) in enumerate(zip(keys.tolist(), (_scatter(keys) & (size - 1)).tolist()), 1):
        while table[slot]:
            slot = (slot + 1) & (size - 1)
        table[slot], columns[slot] = key, column
    return table, columns


class Kernel:
    """Weighted subsequence sums over the subsequences that some strings have."""

    def __init__(self, landmarks: list[str]):
        self.codes = np.array([ord(c) for c in sorted({c for s in landmarks for c in s})], dtype=np.int64)
        groups = [(some, codes, *_triples(n)) for n, some, codes in _by_length(landmarks) if n > 2]
        raw = [self._raw(codes, at).ravel() for _, codes, at, _ in groups]
        self.keys, self.columns = _hash_table(np.unique(np.concatenate([np.zeros(1, np.int64), *raw]))[1:])
        used = self.columns.max(initial=0)
        self.table = np.zeros((len(landmarks), used + 1), dtype=np.float32)
        for some, codes, at, discount in groups:
            norms = np.sqrt(self_kernel(codes))
            for row, k, m in zip(some.tolist(), self._keys(codes, at), norms.tolist()):
                np.add.at(self.table[row], k, discount / m)

    def _raw(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        slot = np.searchsorted(self.codes, codes)
        slot[slot == len(self.codes)] = 0
        letter = np.where(self.codes[slot] == codes, slot + 1, 0)
        size = len(self.codes) + 1
        a, b, c = (letter[:, at[:, i]] for i in range(3))
        return np.where((a > 0) & (b > 0) & (c > 0), (a * size + b) * size + c, 0)

    def _keys(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Columns of the subsequences (0: no landmark has it)."""
        raw = self._raw(codes, at)
        mask = len(self.keys) - 1
        slot = _scatter(raw) & mask
        out = np.where(self.keys[slot] == raw, self.columns[slot], 0)
        open_ = np.nonzero((self.keys[slot] != raw) & (self.keys[slot] != 0))
        while len(open_[0]):
            slot[open_] = (slot[open_] + 1) & mask
            found = self.keys[slot[open_]]
            hit = found == raw[open_]
            out[open_] = np.where(hit, self.columns[slot[open_]], 0)
            again = ~hit & (found != 0)
            open_ = tuple(x[again] for x in open_)
        return out

    def against(self, strings: list[str], table: np.ndarray) -> np.ndarray:
        """Normalised sums of ``table`` (subsequences x columns) over each string."""
        out = np.zeros((len(strings), table.shape[1]), dtype=np.float32)
        for n, some, codes in _by_length(strings):
            at, discount = _triples(n)
            if not len(at):
                continue
            norm = np.sqrt(self_kernel(codes))
            keys = self._keys(codes, at)
            if table.shape[1] == 1:
                out[some, 0] = (table[keys, 0] * discount).sum(axis=1) / norm
            else:
                for row, k, m in zip(some.tolist(), keys, norm.tolist()):
                    use = k > 0
                    out[row] = discount[use] @ table[k[use]] / m
        return out


class Model:
    """Margins of units through a table of subsequence weights, and the
    calibration over a document's worst units."""

    def __init__(self, kernel: Kernel | None, weights: np.ndarray | None, bias: float, link: tuple[str, tuple[float, ...]]):
        self.kernel, self.weights, self.bias, self.link = kernel, weights, bias, link
        self.starts: frozenset[str] = frozenset()
        self.known: dict[str, float] = {}

    def margins(self, texts: list[str]) -> list[float]:
        """The margin of each unit: that of its worst piece (the bias if none)."""
        parts = [pieces(u) for u in texts]
        flat = [p for ps in parts for p in ps]
        out = np.full(len(texts), self.bias)
        if flat:
            each = self.kernel.against(flat, self.weights)[:, 0] + self.bias
            sizes = np.array([len(ps) for ps in parts])
            some = np.flatnonzero(sizes)
            starts = np.cumsum(sizes[some]) - sizes[some]
            out[some] = np.maximum.reduceat(each, starts)
        return out.tolist()

    def worst(self, docs: list[list[str]]) -> np.ndarray:
        """The margins of the WORST worst distinct units of each document (the
        bias where it has fewer). Units that the task has not met are scored
        together."""
        out = np.full((len(docs), WORST), self.bias)
        if self.kernel is None:
            return out
        known = self.known
        sets = [set(tokens).union(windows(tokens, self.starts)) for tokens in docs]
        new = set().union(*sets) - known.keys()
        if len(known) + len(new) > CACHE:
            known.clear()
            new = set().union(*sets)
        fresh = list(new)
        known.update(zip(fresh, self.margins(fresh)))
        for row, tokens in zip(out, sets):
            m = np.fromiter(map(known.__getitem__, tokens), dtype=np.float64, count=len(tokens))
            if len(m) > WORST:
                m = np.partition(m, len(m) - WORST)[-WORST:]
            row[:len(m)] = m
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        kind, values = self.link
        worst = self.worst([units(x) for x in texts])
        return (_any_toxic if kind == "any" else _add_up)(worst, *values)

    def to_bytes(self) -> bytes:
        small = None
        if self.kernel is not None:
            small = (self.kernel.codes, self.kernel.keys, self.kernel.columns, self.weights)
        return pickle.dumps((small, self.bias, self.link, sorted(self.starts)))

    @staticmethod
    def from_bytes(data: bytes) -> Model:
        small, bias, link, starts = pickle.loads(data)
        if small is None:
            return Model(None, None, bias, link)
        kernel = Kernel.__new__(Kernel)
        kernel.codes, kernel.keys, kernel.columns, weights = small
        model = Model(kernel, weights, bias, link)
        model.starts = frozenset(starts)
        return model


def _svm(z: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss in the primal, by Newton steps."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(x.shape[1])
    reg = np.full(x.shape[1], ridge)
    reg[-1] = 1e-3
    value = np.inf
    for _ in range(30):
        slack = np.maximum(0.0, 1.0 - y * (x @ w))
        now = 0.5 * (reg * w * w).sum() + (cost * slack * slack).sum()
        active = slack > 0
        if value - now < 1e-6 * abs(now):
            break
        value = now
        xa, ca = x[active], cost[active]
        gradient = reg * w - 2 * xa.T @ (ca * y[active] * slack[active])
        w = w - np.linalg.solve(2 * (xa * ca[:, None]).T @ xa + np.diag(reg), gradient)
    return w[:-1], float(w[-1])


def _probability(t: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(t, -30, 30)))


def _any_toxic(margins: np.ndarray, slope: float, centre: float) -> np.ndarray:
    """The probability that any of the units is toxic, each being so with a
    logistic probability of its margin."""
    t = np.clip(slope * (margins - centre), -30, 30)
    return 1.0 - np.exp(-np.log1p(np.exp(t)).sum(axis=1))


def _add_up(margins: np.ndarray, steep: float, centre: float, offset: float, slope: float) -> np.ndarray:
    """A logistic probability of what the units weigh together: little below the
    centre, in proportion to the margin above it. Several doubtful units count."""
    return _probability(offset + slope * np.logaddexp(0.0, steep * (margins - centre)).sum(axis=1))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """(offset, slope) of a logistic regression on one feature, by Newton steps
    with a weak ridge on the slope."""
    x = np.column_stack([np.ones(len(x)), x])
    w, reg = np.zeros(2), np.array([1e-6, ridge])
    for _ in range(30):
        p = _probability(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(reg), x.T @ (p - y) + reg * w)
        w = w - np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def _calibrate(margins: np.ndarray, y: np.ndarray) -> tuple[str, tuple[float, ...]]:
    """The link, and its parameters, under which the labels are likeliest: one
    toxic unit is enough, or doubtful units add up."""
    def loss(p: np.ndarray) -> float:
        p = np.clip(p, 1e-6, 1 - 1e-6)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())

    found = [(loss(_any_toxic(margins, s, c)) + 0.1 * s, "any", (s, c))
             for s in np.exp2(np.linspace(0, 5, 16)).tolist() for c in np.linspace(-1, 2, 31).tolist()]
    for steep in (2.0, 4.0, 8.0):
        for centre in np.linspace(-0.75, 1.25, 9).tolist():
            w = _logistic(np.logaddexp(0.0, steep * (margins - centre)).sum(axis=1), y)
            if w[1] > 0:
                found.append((loss(_add_up(margins, steep, centre, *w)) + 0.1 * steep * w[1], "sum",
                              (steep, centre, *w)))
    # That one unit is enough is the rule; adding up must explain clearly more.
    return min((x + (0.002 * len(y) if kind == "sum" else 0.0), kind, values) for x, kind, values in found)[1:]


def _worst_piece(model: Model, unit: str) -> str:
    """The piece of a unit with the greatest margin (before the first fit: the first)."""
    found = pieces(unit)
    if len(found) == 1 or model.kernel is None:
        return found[0]
    return found[int(np.argmax(model.kernel.against(found, model.weights)[:, 0]))]


def _insert(piece: str, rng: np.random.Generator) -> str:
    """The piece with a random character somewhere inside."""
    at = int(rng.integers(2, max(3, len(piece))))
    return piece[:at] + "abcdefghijklmnopqrstuvwxyz0123456789.-_*"[int(rng.integers(40))] + piece[at:]


def _evidence(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int) -> dict[str, float]:
    """For each unit the likelihood-ratio statistic of its use in toxic against
    clean documents; 0 where it is less than ODDS times as likely in toxic ones."""
    out = {}
    share = n_toxic / (n_toxic + n_clean)
    for u, c in toxic.items():
        n = c + clean[u]
        g = 2 * c * np.log(c / (n * share)) + (2 * clean[u] * np.log(clean[u] / (n * (1 - share))) if clean[u] else 0.0)
        if pieces(u):
            out[u] = g if c * n_clean >= ODDS * max(clean[u], 0.1) * n_toxic else 0.0
    return out


def inner_strings(unit: str) -> set[str]:
    """The short strings inside a long unit, one of which may be the insult."""
    core = unit.strip(_EDGES)
    return {core[i:i + n] for n in INNER for i in range(len(core) - n + 1)} if len(core) > PIECE else set()


def _choose_landmarks(evidence: dict[str, float], clean: Counter) -> list[str]:
    """Units that tell toxic documents best, no two too alike, then the clean
    units that are most like them, then common ones."""
    telling = sorted((u for u, g in evidence.items() if g > 4), key=lambda u: (-evidence[u], u))
    chosen: list[str] = []
    if telling:
        names = list(dict.fromkeys(p for u in telling[:TELLING] for p in pieces(u)))
        kernel = Kernel(names)
        alike = kernel.table @ kernel.table.T
        free = np.ones(len(names), dtype=bool)
        for i in range(len(names)):
            if free[i] and len(chosen) < LANDMARKS // 2:
                chosen.append(names[i])
                free &= alike[i] < 0.9
    common = list(dict.fromkeys(p for u, _ in clean.most_common(COMMON) for p in pieces(u)))
    if chosen and common:
        kernel = Kernel(chosen)
        near = kernel.against(common, np.ascontiguousarray(kernel.table.T)).max(axis=1)
        hard = [common[i] for i in np.argsort(-near, kind="stable")[:LANDMARKS // 4].tolist()]
        chosen += hard
    chosen += common[:LANDMARKS - len(chosen)]
    return list(dict.fromkeys(chosen))


def fit(texts: list[str | None], labels: np.ndarray, seed: int = 7) -> Model:
    """SVM on four fifths of the documents, calibration on all. Without both
    classes, a constant score."""
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    constant = Model(None, None, 0.0, ("sum", (1.0, 0.0, float(np.log(share / (1 - share))), 0.0)))
    if len(labels) < 10 or labels.min() == labels.max():
        return constant
    rng = np.random.default_rng(seed)
    fold = rng.random(len(texts)) < 0.2
    learn = [i for i in range(len(texts)) if not fold[i]]
    one: dict[str, str] = {}  # equal units share one string
    bags = [[one.setdefault(u, u) for u in dict.fromkeys(units(texts[i]))] for i in learn]
    toxic, clean = Counter(), Counter()
    for i, bag in zip(learn, bags):
        (toxic if labels[i] else clean).update(bag)
    n_toxic = max(1, int(sum(labels[i] for i in learn)))
    n_clean = max(1, len(learn) - n_toxic)
    inside, clean_inside = Counter(), Counter()
    for i, bag in zip(learn, bags):
        (inside if labels[i] else clean_inside).update(set().union(*map(inner_strings, bag)))
    inner = {x: g for x, g in _evidence(inside, clean_inside, n_toxic, n_clean).items() if g >= EVIDENCE}
    evidence = _evidence(toxic, clean, n_toxic, n_clean)
    landmarks = _choose_landmarks(evidence | inner, clean)
    if not landmarks or not clean or not toxic:
        return constant
    kernel = Kernel(landmarks)
    columns = np.ascontiguousarray(kernel.table.T)
    # Nyström: the features of a string are its kernels with the landmarks times K_ll^(-1/2).
    values, vectors = np.linalg.eigh((kernel.table @ kernel.table.T).astype(np.float64) + 1e-3 * np.eye(len(landmarks)))
    root = vectors @ np.diag(values ** -0.5) @ vectors.T

    def nystroem(strings: list[str]) -> np.ndarray:
        return kernel.against(strings, columns) @ root

    clean_units = sorted(u for u in clean if pieces(u))
    toxic_units = sorted(u for u in toxic if not clean[u] and pieces(u))
    rng.shuffle(clean_units)
    ranked = sorted(evidence, key=lambda u: (-evidence[u], u))
    witnesses = {u for u in ranked if evidence[u] >= EVIDENCE} | set(inner) or set(ranked[:5])
    negatives = [u for u in clean_units if u not in witnesses][:MAX_NEGATIVES // 2]
    model = constant
    for turn in range(ROUNDS):
        positive = sorted(witnesses)
        if not positive:
            return constant
        # Of a unit of several pieces the worst one stands for it. Each also with a
        # character inserted, so that this costs little margin.
        stand = [_worst_piece(model, u) for u in positive]
        spread = [_insert(p, rng) for p in stand]
        clean_pieces = [(u, p) for u in negatives for p in pieces(u)]
        strings = stand + spread + [p for _, p in clean_pieces]
        y = np.concatenate([np.ones(2 * len(positive)), -np.ones(len(clean_pieces))])
        uses = np.array([min(max(toxic[u], inside[u]), 20) for u in positive] * 2 + [1.0] * len(clean_pieces), dtype=float)
        cost = uses * np.where(y > 0, 0.5 / uses[y > 0].sum(), 0.5 / max(1, len(clean_pieces))) * 2_000
        w, bias = _svm(nystroem(strings), y, cost)
        weights = (columns @ (root @ w)).astype(np.float32)[:, None]
        weights[0] = 0.0  # subsequences with a character that no landmark has
        model = Model(kernel, weights, bias, constant.link)
        if turn == ROUNDS - 1:
            break
        # The worst clean units join the negatives; the worst units of each toxic document stand for it.
        margins = dict(zip(clean_units + toxic_units, model.margins(clean_units + toxic_units)))
        hard = sorted((u for u in clean_units if margins[u] > -1), key=lambda u: (-margins[u], u))
        witnesses = set()
        for i, bag in zip(learn, bags):
            if labels[i]:
                best = sorted(((margins[u], u) for u in bag if u in margins and evidence.get(u, 0) > 0), reverse=True)
                witnesses.update(u for m, u in best[:3] if m > 0)
        negatives = [u for u in dict.fromkeys(hard[:MAX_NEGATIVES // 2] + negatives)
                     if u not in witnesses][:MAX_NEGATIVES]
    told = [u.strip(_EDGES) for u in witnesses if evidence.get(u, inner.get(u, 0.0)) >= EVIDENCE]
    model.starts = frozenset(u[:START] for u in told if len(u) >= START)
    model.link = _calibrate(model.worst([units(t) for t in texts]), labels)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 3, remainder: int = 1,
          max_train: int = MAX_TRAIN) -> bytes:
    """The fitted model, as bytes (its size does not depend on the input)."""
    sample = sample_labels(labels, label, modulus, remainder, max_train)
    chosen = labelled_texts(docs, sample).select("doc_id", "text", "__label")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (r["doc_id"], r["__label"], r["text"] or ""))
        model = fit([r["text"] for r in rows], np.array([r["__label"] for r in rows], dtype=np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], names=["model"])

    found = chosen.repartition(1).mapInArrow(learn, "model binary").first()
    return found["model"] if found else fit([], np.zeros(0)).to_bytes()


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 3, remainder: int = 1,
                   max_train: int = MAX_TRAIN, threshold: float = THRESHOLD,
                   keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with held_out, score and predicted.

    score is the probability of label 1 and only depends on the text; ids whose
    crc32 leaves ``remainder`` teach nothing and are held_out. Null and empty
    texts score as texts without a toxic unit. Without labels, or with one
    class, every text has the same score. Columns with the names of the results
    are replaced.
    """
    data = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label, modulus, remainder, max_train))
    base = without(docs, "held_out", "score", "predicted")
    carried = [f for f in base.schema.fields if keep is None or f.name in keep]
    schema = T.StructType(carried + [T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.from_bytes(data.value)
        for batch in batches:
            scores: list[float] = []
            for part in chunks(batch.column("text").to_pylist()):
                scores += model.scores(part).tolist()
            columns = [batch.column(f.name) for f in carried] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    needed = {f.name for f in carried} | {"text"}
    scored = base.select([c for c in base.columns if c in needed]).mapInArrow(score, schema)
    return scored.withColumns({"held_out": held_out(F.col("doc_id"), modulus, remainder),
                               "predicted": (F.col("score") >= threshold).cast("int")})
