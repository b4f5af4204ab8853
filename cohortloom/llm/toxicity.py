"""Toxicity by Levenshtein automata intersected with a lexicon trie.

The lexicon is learned: words, and beginnings of words (``stem*``), that labelled toxic texts hold
far more often than clean ones, in many different contexts (a copied text teaches a term once). The
terms form a trie; the automaton of all words within a term's edit distance is intersected with it
lazily, state by state, and numpy runs all words of a piece of text through it at once. Terms of
up to four letters allow no edit, of up to nine one, longer ones two; a stem allows one from seven.

Each match counts with its term's weight, less for each edit. Windows around the matches separate
abuse from quotation: matches within quotation marks, and matches close to others, are
features of their own. A logistic model on these features gives the score.

Labelled rows are taken for learning in the order of a hash of their id, ``MOST_LABELLED`` at most, toxic ones up to
half of that bound before clean ones are taken: rare toxic labels all teach, and the model's bias is corrected for
their true share. The lexicon is made of all these rows; for the weights, either half of them is measured
with the terms of the other half, so that no weight is fitted on the rows that chose the terms. The lexicon is
bounded by its terms' lift alone. Scores read the text alone.

Defined results: a null or empty text has no match and gets the score of such texts; without a toxic
or without a clean label all scores are 0; a null label teaches nothing; an id with several labels is
toxic if one is, and one of its texts, that of the smallest hash, teaches; terms of equal worth are taken in alphabetical
order; repeated rows are scored each time; other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortloom.llm.textbytes import Piece, pieces
from cohortloom.session import cut_lineage, scratch_path

MOST_LABELLED = 20_000
#: A term needs so many toxic texts and contexts, and to be so many times as frequent in them.
LEAST_TEXTS = 3
LEAST_LIFT = 20.0
#: What chance may not exceed: that a term as frequent as in clean texts is in so many toxic ones.
MOST_CHANCE = 1e-6
STEM_LENGTHS = range(4, 10)
WINDOW_WORDS = 8
FEATURES = 7
#: Rows that a task gathers before it hands them on.
MOST_HELD = 200_000
PREDICT_AT = 0.7
#: What a match is worth after so many edits.
EDIT_WORTH = (1.0, 0.6, 0.4)

_WORD = re.compile(r"[^\W_]+")
_BMP = 0x10000
INSIDE = "*@$"
QUOTES = "\"“”«»„‟"


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each character of the basic plane: its lower case, whether a letter or digit, whether also allowed within words."""
    lower = np.arange(_BMP, dtype=np.uint32)
    letter = np.zeros(_BMP, bool)
    for c in range(_BMP):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()
        if len(low) == 1:
            lower[c] = ord(low)
        letter[c] = chr(c).isalnum()
    inside = letter.copy()
    inside[[ord(c) for c in INSIDE]] = True
    return lower, letter, inside


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool
    weight: float

    @property
    def edits(self) -> int:
        n = len(self.text)
        return int(n >= 7) if self.stem else int(n >= 5) + int(n >= 10)


class Automaton:
    """The words within the terms' edit distances, as a deterministic automaton built where it is needed."""

    def __init__(self, terms: list[Term]):
        letters = sorted({c for t in terms for c in t.text})
        self.code = np.zeros(_BMP, np.int16)  # 0: a character of no term
        for i, c in enumerate(letters):
            if ord(c) < _BMP:
                self.code[ord(c)] = i + 1
        number = {c: i + 1 for i, c in enumerate(letters)}
        self.children: list[dict[int, int]] = [{}]
        self.allowed = [0]
        self.ends: list[list[int]] = [[]]
        self.terms = terms
        for i, term in enumerate(terms):
            node = 0
            for c in term.text:
                self.allowed[node] = max(self.allowed[node], term.edits)
                if number[c] not in self.children[node]:
                    self.children[node][number[c]] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                    self.ends.append([])
                node = self.children[node][number[c]]
            self.allowed[node] = max(self.allowed[node], term.edits)
            self.ends[node].append(i)
        self.longest = max((len(t.text) + t.edits for t in terms), default=0)
        self.states: list[dict[int, int]] = [{}]
        self.numbers: dict[frozenset, int] = {frozenset(): 0}
        self.next = np.zeros((64, len(letters) + 1), np.int32)
        self.accept = np.full((64, 2), -1, np.int64)  # best whole word, best stem: term * 4 + edits
        self.start = self._number(self._closed({0: 0})) if terms else 0

    def _closed(self, state: dict[int, int]) -> dict[int, int]:
        """With the states that skip letters of a term."""
        todo = list(state)
        while todo:
            node = todo.pop()
            edits = state[node] + 1
            for child in self.children[node].values():
                if edits <= self.allowed[child] and edits < state.get(child, 9):
                    state[child] = edits
                    todo.append(child)
        return state

    def _number(self, state: dict[int, int]) -> int:
        key = frozenset(state.items())
        if key in self.numbers:
            return self.numbers[key]
        n = self.numbers[key] = len(self.states)
        self.states.append(state)
        if n >= len(self.next):
            self.next = np.concatenate([self.next, np.zeros_like(self.next)])
            self.accept = np.concatenate([self.accept, np.full_like(self.accept, -1)])
        self.next[n] = -1
        for stem in (0, 1):
            best = None
            for node, edits in state.items():
                for i in self.ends[node]:
                    if self.terms[i].stem == bool(stem) and edits <= self.terms[i].edits:
                        worth = self.terms[i].weight * EDIT_WORTH[edits]
                        best = max(best or (-1.0, 0, 0), (worth, i, edits))
            self.accept[n, stem] = -1 if best is None else best[1] * 4 + best[2]
        return n

    def _step(self, state: int, letter: int) -> int:
        out: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.allowed[node] and edits < out.get(node, 9):
                out[node] = edits

        for node, edits in self.states[state].items():
            if letter in self.children[node]:
                reach(self.children[node][letter], edits)
            reach(node, edits + 1)
            for child in self.children[node].values():
                reach(child, edits + 1)
        n = self._number(self._closed(out)) if out else 0
        self.next[state, letter] = n
        return n

    def run(self, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of each word the best match as term * 4 + edits, or -1."""
        best = np.full(len(starts), -1, np.int64)
        if not self.terms:
            return best
        worth = np.full(len(starts), -1.0)
        codes = np.where(chars < _BMP, self.code[np.minimum(chars, _BMP - 1)], 0)
        alive = np.arange(len(starts))
        state = np.full(len(starts), self.start, np.int32)
        for step in range(self.longest + 1):
            if step:
                self._note(best, worth, alive, self.accept[state, 1])
            ended = ends[alive] - starts[alive] == step
            self._note(best, worth, alive[ended], self.accept[state[ended], 0])
            alive, state = alive[~ended], state[~ended]
            if not len(alive) or step == self.longest:
                return best
            letter = codes[starts[alive] + step]
            after = self.next[state, letter]
            if (after < 0).any():
                for pair in np.unique(state[after < 0].astype(np.int64) * 65536 + letter[after < 0]).tolist():
                    self._step(pair >> 16, pair & 65535)
                after = self.next[state, letter]
            going = after > 0
            alive, state = alive[going], after[going]
        return best

    def _note(self, best: np.ndarray, worth: np.ndarray, words: np.ndarray, found: np.ndarray) -> None:
        hit = found >= 0
        for word, match in zip(words[hit].tolist(), found[hit].tolist(), strict=True):
            own = self.terms[match >> 2].weight * EDIT_WORTH[match & 3]
            if own > worth[word]:
                worth[word], best[word] = own, match


@dataclass
class Model:
    terms: list[Term] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    bias: float = -math.inf
    mean: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    scale: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.bias == -math.inf:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip((features - self.mean) / self.scale @ self.weights + self.bias, -40, 40)))


@dataclass
class Words:
    chars: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    quoted: np.ndarray


def words_of(piece: Piece) -> Words:
    """Words of a piece: runs of letters, digits and ``INSIDE``, trimmed to letters and digits."""
    lower, letter, inside = _tables()
    chars = np.frombuffer(piece.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    to = np.concatenate([[0], np.cumsum((piece.data & 0xC0) != 0x80)])
    bounds = to[piece.bounds]
    basic = np.minimum(chars, _BMP - 1)
    is_letter = letter[basic] | (chars >= _BMP)
    is_inside = inside[basic] | (chars >= _BMP)
    first = np.zeros(len(chars) + 1, bool)
    first[bounds[:-1]] = True
    first = first[: len(chars)]
    run = np.cumsum(first | ~is_inside) * 2 + is_inside  # equal within a run of a row
    at = np.flatnonzero(is_letter)
    if not len(at):
        none = np.empty(0, np.int64)
        return Words(chars, none, none, none, np.empty(0, bool))
    new = np.flatnonzero(np.diff(run[at], prepend=-1))
    starts, ends = at[new], np.append(at[new[1:] - 1], at[-1]) + 1
    rows = np.searchsorted(bounds, starts, "right") - 1
    marks = np.isin(chars, [ord(c) for c in QUOTES])
    lines = first | (chars == 0x0A)
    opened = np.cumsum(marks)
    line = np.cumsum(lines)
    base = opened[np.flatnonzero(lines)] - marks[np.flatnonzero(lines)]
    quoted = (opened[starts] - base[line[starts] - 1]) % 2 == 1
    low = np.where(chars < _BMP, lower[basic], chars)
    return Words(low, starts, ends, rows, quoted)


def features(piece: Piece, automaton: Automaton) -> np.ndarray:
    """What the matches of each row amount to."""
    out = np.zeros((len(piece), FEATURES))
    words = words_of(piece)
    match = automaton.run(words.chars, words.starts, words.ends)
    at = np.flatnonzero(match >= 0)
    if not len(at):
        return out
    total = np.bincount(words.rows, minlength=len(piece))
    terms, edits = match[at] >> 2, match[at] & 3
    weight = np.array([t.weight for t in automaton.terms])[terms] * np.array(EDIT_WORTH)[edits]
    rows, quoted, exact = words.rows[at], words.quoted[at], edits == 0
    close = np.zeros(len(at), bool)
    near = (np.diff(at) <= WINDOW_WORDS) & (np.diff(rows) == 0)
    close[1:] |= near
    close[:-1] |= near
    plain = ~quoted
    np.maximum.at(out[:, 0], rows[plain & exact], weight[plain & exact])
    np.maximum.at(out[:, 1], rows[plain & ~exact], weight[plain & ~exact])
    np.maximum.at(out[:, 2], rows[quoted], weight[quoted])
    np.add.at(out[:, 3], rows[plain], weight[plain])
    np.add.at(out[:, 4], rows[plain & close], 1)
    np.add.at(out[:, 5], rows[plain], 1)
    np.add.at(out[:, 6], rows[quoted], 1)
    out[:, 5] = 1000 * out[:, 5] / (total + 50)
    out[:, 3:] = np.log1p(out[:, 3:])
    return out


def _terms_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in STEM_LENGTHS if n < len(word))]


def _counted(counts: Counter) -> pa.RecordBatch:
    columns = [pa.array([t for t, _ in counts], pa.string()), pa.array([h for _, h in counts], pa.int32()), pa.array(counts.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["term", "half", "n"])


def _words(text: pa.Scalar) -> list[str]:
    return _WORD.findall((text.as_py() or "").lower())


class _Known:
    """The terms of a word, only those of a set if one is given; words are remembered up to a bound."""

    def __init__(self, terms: set[str] | None):
        self.terms, self.kept = terms, {}

    def __call__(self, word: str) -> list[str]:
        found = self.kept.get(word)
        if found is None:
            if len(self.kept) > MOST_HELD:
                self.kept.clear()
            found = self.kept[word] = [t for t in _terms_of(word) if self.terms is None or t in self.terms]
        return found


def _texts_with(shared) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(term, half, n): texts that hold the term; partial sums."""
        of, counts = _Known(shared and shared.value), Counter()
        for batch in batches:
            for text, half in zip(batch.column("text"), batch.column("half").to_pylist(), strict=True):
                counts.update({(t, half) for w in set(_words(text)) for t in of(w)})
                if len(counts) > MOST_HELD:
                    yield _counted(counts)
                    counts = Counter()
        yield _counted(counts)

    return count


def _contexts(shared) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(term, half, context): the word with its neighbours, once in a batch."""
        of = _Known(shared.value)
        for batch in batches:
            out: set[tuple[str, int, int]] = set()
            for text, half in zip(batch.column("text"), batch.column("half").to_pylist(), strict=True):
                around = ["", *_words(text), ""]
                out |= {(t, half, _stable(tuple(around[i : i + 3]))) for i, w in enumerate(around[1:-1]) for t in of(w)}
            rows = list(out)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int32(), pa.int64()))], ["term", "half", "context"])

    return find


def _stable(context: tuple[str, ...]) -> int:
    return xxhash.xxh64_intdigest(" ".join(context)) >> 1


def _tells(n: int, innocent: int, toxic: int, clean: int) -> bool:
    """Whether a term with so many toxic contexts and clean texts, of so many texts of either kind, is one of the lexicon."""
    if n < LEAST_TEXTS or not toxic or not clean:
        return False
    rate = (innocent + 0.5) / (clean + 1)
    return (n + 0.5) / (toxic + 1) >= LEAST_LIFT * rate and _chance(n, toxic * rate) <= MOST_CHANCE


def _least(toxic: int, clean: int) -> int:
    """Texts that a term needs if no clean text holds it."""
    return next((n for n in range(LEAST_TEXTS, toxic + 1) if _tells(n, 0, toxic, clean)), toxic + 1)


def _per_half(sample: DataFrame, count: Callable) -> DataFrame:
    """(term, n0, n1, n2): texts that hold the term, in either half and in both."""
    counts = sample.select("text", "half").mapInArrow(count, "term string, half int, n long")
    halves = [F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0)).alias(f"n{h}") for h in (0, 1)]
    return counts.groupBy("term").agg(*halves, F.sum("n").alias("n2"))


def _lexicons(sample: DataFrame) -> list[list[Term]]:
    """The terms that tell toxic from clean texts in the halves 0 and 1 of a bounded sample (text, toxic, half), and in all of it.

    Terms that could not be among them with every toxic text a context of its own go before contexts are told apart.
    """
    context = sample.sparkSession.sparkContext
    sizes = Counter({(r["toxic"], r["half"]): r["n"] for r in sample.groupBy("toxic", "half").agg(F.count(F.lit(1)).alias("n")).collect()})
    toxic, clean = ([sizes[k, 0], sizes[k, 1], sizes[k, 0] + sizes[k, 1]] for k in (1, 0))
    if not toxic[2] or not clean[2]:
        return [[], [], []]
    bad, good = sample.where("toxic = 1"), sample.where("toxic = 0")
    able = [F.col(f"n{i}") >= _least(toxic[i], clean[i]) for i in range(3)]
    held = {r["term"]: (r["n0"], r["n1"], r["n2"]) for r in _per_half(bad, _texts_with(None)).where(reduce(Column.__or__, able)).collect()}
    counts = _per_half(good, _texts_with(context.broadcast(set(held))))
    innocent = {r["term"]: (r["n0"], r["n1"], r["n2"]) for r in counts.collect()}
    none = (0, 0, 0)
    able = {t for t, n in held.items() if any(_tells(n[i], innocent.get(t, none)[i], toxic[i], clean[i]) for i in range(3))}
    rows = bad.select("text", "half").mapInArrow(_contexts(context.broadcast(able)), "term string, half int, context long")
    halves = [F.count_distinct(F.when(F.col("half") == h, F.col("context"))).alias(f"c{h}") for h in (0, 1)]
    found = rows.groupBy("term").agg(*halves, F.count_distinct("context").alias("c2")).collect()
    return [_choose({r["term"]: (min(r[f"c{i}"], held[r["term"]][i]), innocent.get(r["term"], none)[i]) for r in found}, toxic[i], clean[i]) for i in range(3)]


def _chance(n: int, mean: float) -> float:
    """A bound on the probability that a Poisson number of this mean reaches ``n`` (above the mean)."""
    return math.exp(n - mean + n * math.log(mean / n)) if n > mean else 1.0


def _choose(found: dict[str, tuple[int, int]], toxic: int, clean: int) -> list[Term]:
    """Terms by (toxic contexts, clean texts), those that tell most first."""
    scored, texts = [], {}
    for term, (n, innocent) in found.items():
        if _tells(n, innocent, toxic, clean):
            weight = math.log((n + 0.5) / (toxic + 1)) - math.log((innocent + 0.5) / (clean + 1))
            scored.append((n * weight, term, weight))
            texts[term] = n
    # A stem gives way to a longer term that has nearly all of its texts.
    most: dict[str, int] = {}
    for _, term, _ in scored:
        text = term.rstrip("*")
        for n in range(1, len(text) + (not term.endswith("*"))):
            most[text[:n]] = max(most.get(text[:n], 0), texts[term])
    scored = [x for x in scored if not x[1].endswith("*") or most.get(x[1][:-1], 0) < 0.9 * texts[x[1]]]
    chosen: list[Term] = []
    stems: set[str] = set()
    for _, term, weight in sorted(scored, key=lambda x: (-x[0], x[1])):
        text, stem = term.rstrip("*"), term.endswith("*")
        if len(text) >= 3 and not any(text[:n] in stems for n in range(1, len(text) + 1)):
            chosen.append(Term(text, stem, min(weight, 8.0)))
            if stem:
                stems.add(text)
    return chosen


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 200) -> Model:
    """Logistic regression with a ridge, by Newton steps that are halved until the loss falls, up to a flat gradient."""
    mean, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    w[-1] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    penalty = np.array([ridge] * x.shape[1] + [1e-9])

    def loss(w: np.ndarray) -> float:
        s = z @ w
        return float(np.logaddexp(0, s).sum() - y @ s + 0.5 * penalty @ (w * w))

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        slope = z.T @ (p - y) + penalty * w
        if np.abs(slope).max() < 1e-7 * len(y):
            break
        step = np.linalg.solve(z.T * (p * (1 - p)) @ z + np.diag(penalty + 1e-9), slope)
        rate, gain = 1.0, slope @ step
        while (after := loss(w - rate * step)) > now - 1e-4 * rate * gain and rate > 1e-12:
            rate /= 2
        if after >= now:
            break
        w, now = w - rate * step, after
    return Model(weights=w[:-1], bias=float(w[-1]), mean=mean, scale=scale)


def _drawn(named: DataFrame, most: int) -> tuple[DataFrame, float]:
    """At most ``most`` labels, those of the smallest hashes of each kind, and how much the toxic ones' odds rose by that."""
    drawn = F.pmod(F.xxhash64("_id"), F.lit(1 << 40))
    total = {r["toxic"]: r["n"] for r in named.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    take = {1: min(toxic, max(most // 2, most - clean))}
    take[0] = min(clean, most - take[1])
    parts = []
    for kind, n in take.items():
        own = named.where(F.col("toxic") == kind)
        if total.get(kind, 0) > n:
            # A bound on the hash first, so that no task sees many more than are taken.
            own = own.where(drawn < int((1 << 40) * min(1.0, (1.1 * n + 100) / total[kind])))
        parts.append(own.orderBy(drawn, "_id").limit(n))
    if not toxic or not clean or not take[0] or not take[1]:
        return parts[0].unionByName(parts[1]), 0.0
    return parts[0].unionByName(parts[1]), math.log(take[1] / take[0]) - math.log(toxic / clean)


def learn(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_labelled: int = MOST_LABELLED) -> Model:
    """Lexicon and weights from at most ``most_labelled`` of the given labels, one text to each."""
    spark = documents.sparkSession
    named = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic")).where("_id is not null and toxic is not null")
    named = named.groupBy("_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    taken, raised = _drawn(named, most_labelled)
    taken = cut_lineage(taken)
    path = scratch_path(spark, "labelled")
    texts = documents.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    joined = texts.join(F.broadcast(taken), "_id").groupBy("_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    joined.select("text", "toxic", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(2)).cast("int").alias("half")).write.parquet(path)
    sample = spark.read.parquet(path)
    one, two, terms = _lexicons(sample)
    if not terms:
        return Model()
    shared = spark.sparkContext.broadcast((two, one))  # each half is measured by the other half's terms

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [Automaton(t) if t else None for t in shared.value]
        for batch in batches:
            halves = np.array(batch.column("half"))
            for half, automaton in enumerate(automata):
                own = batch.take(pa.array(np.flatnonzero(halves == half)))
                if automaton is None or not own.num_rows:
                    continue
                for piece in pieces(own.column("text")):
                    found = features(piece, automaton)
                    arrays = [own.column("toxic").slice(piece.first, len(piece)), pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), FEATURES).cast(pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(arrays, ["toxic", "x"])

    rows = sample.mapInArrow(measure, "toxic int, x array<double>").collect()
    y = np.array([r["toxic"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return Model()
    model = fit(np.array([r["x"] for r in rows]), y)
    model.terms, model.bias = terms, model.bias - raised
    return model


def score(documents: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, into: str = "toxicity") -> DataFrame:
    """The columns ``keep`` (all) and the score of each document."""
    columns = [c for c in documents.columns if c != into] if keep is None else keep
    rows = documents.select(*columns, F.col(text_col).cast("string").alias("_text"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(shared.value.terms)
        for batch in batches:
            width = batch.num_columns - 1
            for piece in pieces(batch.column(width)):
                own = batch.slice(piece.first, len(piece))
                rated = pa.array(shared.value.score(features(piece, automaton)))
                yield pa.RecordBatch.from_arrays([*own.columns[:width], rated], [*own.schema.names[:width], into])

    return rows.mapInArrow(rate, T.StructType([*rows.schema.fields[:-1], T.StructField(into, T.DoubleType())]))
