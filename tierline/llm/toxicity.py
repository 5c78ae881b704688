"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult (strong or weak), threat, target, negator,
reporting verb, quotation mark, clause end. Small transducers rewrite a clause's
symbols one after the other and are composed into a single machine: negation
turns insults and threats in its scope into negated ones, reported speech into
reported ones, and the target machine raises those aimed at somebody. What
comes out is counted by clause; isolated words count for less than aimed ones,
negated and reported ones for less again, with weights learned from labels.

The insult lexicon (whole words and word beginnings) and the weights of the
final logistic score come from at most ``SAMPLE`` labelled rows, those with the
smallest hash of their id, never from held-out rows. All rows are scored, by
their text alone.

Defined results: a null text is empty and scored as such; rows that share an id
are scored each; a row without an id is scored and not held out; ids with
several labels count as toxic if any is; without usable labels the fixed word
lists and weights decide; a text of any length is scored whole; an empty table
gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierline.llm.common import stored, whole_text

#: Labelled rows used for fitting, terms kept, and the shortest and longest word beginnings tried.
SAMPLE, LEXICON = 20_000, 4_000
PREFIXES = range(4, 8)
#: A term needs this many toxic texts, this share of them, this share of toxic ones among its texts,
#: and is strong from these log-odds on.
SUPPORT, SHARE, PRECISION, STRONG_ODDS = 5, 0.01, 0.9, 5.0
HELD_OUT_OF = 5
#: Words whose symbols a worker remembers, and terms it counts before it passes them on.
REMEMBERED, COUNTED_TERMS = 150_000, 200_000

OTHER, STRONG, WEAK, THREAT, TARGET, NEGATOR, REPORT, QUOTE, END, NEGATED, REPORTED, AIMED, AIMED_THREAT = range(13)
_MARKED = (STRONG, WEAK, THREAT)

# Word lists.
INSULTS = """idiot moron stupid loser scum trash worthless pathetic disgusting clown fool dumb
idiota estúpido imbécil basura idiotin dummkopf abschaum trottel crétin ordure débile""".split()
THREATS = """kill hurt destroy murder shoot stab burn beat strangle töten umbringen schlagen matar
golpear destruir tuer frapper détruire""".split()
TARGETS = """you your yourself he him his she her they them their people everyone du dich dir ihr
euch sie tú usted ustedes ellos te vous tu toi ils elles""".split()
NEGATORS = "not no never nobody nothing isn aren don doesn nicht kein keine nie nunca jamás ne pas jamais ni".split()
REPORTING = """said says say called wrote claimed quoted reported alleged sagte nannte behauptete schrieb
dijo llamó escribió dit appelé écrit affirmé""".split()

_TOKENS = re.compile("[^\\W\\d_]+|[.!?;:,\n\"“”«»]")
_WORDS = re.compile(r"[^\W\d_]+")
_CLAUSES = re.compile(b"[^\x08]*[\x01-\x03][^\x08]*")


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine: ``step(state, symbol)`` gives the next state and a symbol."""
    start: object
    step: Callable[[object, int], tuple[object, int]]

    def then(self, other: "Transducer") -> "Transducer":
        """This machine, its output read by the other."""
        def step(state, symbol):
            first, middle = self.step(state[0], symbol)
            second, out = other.step(state[1], middle)
            return (first, second), out
        return Transducer((self.start, other.start), step)

    def table(self) -> list[list[tuple[int, int]]]:
        """All states reachable from the start (number 0), as rows of (next, output) by symbol."""
        numbers, rows = {self.start: 0}, []
        waiting = [self.start]
        for state in waiting:
            row = []
            for symbol in range(AIMED_THREAT + 1):
                after, out = self.step(state, symbol)
                if after not in numbers:
                    numbers[after] = len(numbers)
                    waiting.append(after)
                row.append((numbers[after], out))
            rows.append(row)
        return rows


def negation(scope: int = 3) -> Transducer:
    def step(left, symbol):
        if symbol == NEGATOR:
            return scope, symbol
        return max(0, left - 1), NEGATED if left and symbol in _MARKED else symbol
    return Transducer(0, step)


def reported_speech() -> Transducer:
    """After a reporting verb and a quotation mark or target, until the clause or quotation ends."""
    def step(state, symbol):
        if symbol == REPORT:
            return "verb", symbol
        if symbol == QUOTE:
            return ("quoted" if state == "verb" else "plain"), symbol
        return state, REPORTED if state == "quoted" and symbol in _MARKED else symbol
    return Transducer("plain", step)


def aim(reach: int = 5) -> Transducer:
    """Insults and threats near a target, whichever comes first."""
    def step(state, symbol):
        target, marked = state
        nearer = (max(0, target - 1), max(0, marked - 1))
        if symbol == TARGET:
            return (reach, 0), AIMED if marked else symbol
        if symbol in _MARKED:
            aimed = AIMED_THREAT if symbol == THREAT else AIMED
            return (nearer[0], reach), aimed if target else symbol
        return nearer, symbol
    return Transducer((0, 0), step)


GRAMMAR = negation().then(reported_speech()).then(aim())

#: Symbols counted, with the weights that name a clause's score before anything is learned.
COUNTED = {STRONG: 2.0, WEAK: 1.0, THREAT: 0.4, NEGATED: 0.3, REPORTED: 0.2, AIMED: 2.5, AIMED_THREAT: 1.5}
FEATURES = len(COUNTED) + 2
_DEFAULT = np.array([-2.5, *COUNTED.values(), 0.5, 0.5])


@dataclass
class Model:
    """Lexicon and weights; of bounded size, so it travels with the tasks."""
    words: dict[str, int] = field(default_factory=dict)
    prefixes: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: _DEFAULT.copy())


class Symbols(dict):
    """The symbol of a word, worked out once."""

    def __init__(self, model: Model):
        super().__init__()
        self._model = model
        self._fixed = {w: s for s, ws in ((WEAK, INSULTS), (THREAT, THREATS), (TARGET, TARGETS),
                                          (NEGATOR, NEGATORS), (REPORT, REPORTING)) for w in ws}
        self._fixed |= dict.fromkeys(".!?;:,\n", END) | dict.fromkeys("\"“”«»", QUOTE)

    def __missing__(self, word: str) -> int:
        model = self._model
        symbol = model.words.get(word)
        if symbol is None:
            found = [model.prefixes[word[:n]] for n in PREFIXES if len(word) >= n and word[:n] in model.prefixes]
            symbol = min(found) if found else self._fixed.get(word, OTHER)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = symbol
        return symbol


def features(text: str, symbols: Symbols, table: list[list[tuple[int, int]]]) -> list[float]:
    """Counts of the grammar's outputs, of matched clauses, and the highest clause score."""
    counts, clauses, highest = dict.fromkeys(COUNTED, 0), 0, 0.0
    read = bytes(map(symbols.__getitem__, _TOKENS.findall(text.lower())))
    for clause in _CLAUSES.finditer(read):
        state, score = 0, 0.0
        for symbol in clause.group():
            state, out = table[state][symbol]
            if out in counts:
                counts[out] += 1
                score += COUNTED[out]
        clauses, highest = clauses + 1, max(highest, score)
    return [*(math.log1p(n) for n in counts.values()), math.log1p(clauses), highest]


def _probability(model: Model, found: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.weights[0] + found @ model.weights[1:], -30, 30)))


def _scores(model: Model, raw: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, table = Symbols(model), GRAMMAR.table()
        for batch in batches:
            found = np.array([features(t.as_py(), symbols, table) for t in batch.column("text")],
                             np.float64).reshape(-1, FEATURES)
            keys = batch.drop_columns(["text"])
            if raw:
                out = pa.array(found.tolist(), pa.list_(pa.float64()))
            else:
                out = pa.array(_probability(model, found))
            yield pa.RecordBatch.from_arrays([*keys.columns, out], [*keys.schema.names, "score"])
    return score


def held_out(id_column: str = "doc_id") -> Column:
    remainder = F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(HELD_OUT_OF))
    return F.coalesce(remainder == 0, F.lit(False))


def _training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    chosen = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out())
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # At most ``sample`` ids and labels are broadcast.
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
    # Copies would lend all their words the weight of many texts.
    return stored(rows.groupBy(F.sha2("text", 256).alias("text_key")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic")).drop("text_key"), "labelled")


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic texts, and in how many texts, each word and word beginning occurs.

    Counts are passed on whenever ``COUNTED_TERMS`` are held; the caller adds them up.
    """
    counts: dict[tuple[int, str], list[int]] = {}

    def batch():
        columns = list(zip(*((cut, term, bad, whole) for (cut, term), (bad, whole) in counts.items()))) or [()] * 4
        kinds = pa.int32(), pa.string(), pa.int64(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["cut", "term", "bad", "all"])

    for rows in batches:
        for toxic, text in zip(rows.column(0).to_pylist(), rows.column(1)):
            words = set(_WORDS.findall(text.as_py().lower()))
            terms = {(0, w) for w in words} | {(n, w[:n]) for w in words for n in PREFIXES if len(w) >= n}
            for term in terms:
                count = counts.setdefault(term, [0, 0])
                count[0] += toxic
                count[1] += 1
            if len(counts) >= COUNTED_TERMS:
                yield batch()
                counts.clear()
    yield batch()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lexicon: int = LEXICON) -> Model:
    """A model from labels (doc_id, toxic) of at most ``sample`` rows that are not held out."""
    rows = _training_rows(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), sample)
    sizes = dict(rows.groupBy("toxic").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    model = Model()
    if min(toxic, clean) < SUPPORT:
        return model
    counted = (rows.select("toxic", "text").mapInArrow(_terms, "cut int, term string, bad long, all long")
               .groupBy("cut", "term").agg(F.sum("bad").alias("bad"), F.sum("all").alias("all")))
    odds = F.log(((F.col("bad") + 0.5) / (toxic + 1)) / ((F.col("all") - F.col("bad") + 0.5) / (clean + 1)))
    kept = (counted.filter(F.col("bad") >= max(SUPPORT, SHARE * toxic)).filter(F.col("bad") >= PRECISION * F.col("all"))
            .withColumn("odds", odds).orderBy(F.desc("odds"), "cut", "term").limit(lexicon).collect())
    for r in kept:
        (model.prefixes if r["cut"] else model.words)[r["term"]] = STRONG if r["odds"] >= STRONG_ODDS else WEAK
    found = rows.select("toxic", "text").mapInArrow(_scores(model, raw=True), "toxic int, score array<double>").collect()
    model.weights = _logistic(np.array([r["score"] for r in found]), np.array([r["toxic"] for r in found], float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the intercept first, without penalty."""
    x = np.hstack([np.ones((len(x), 1)), x])
    penalty, w = np.diag([0.0] + [ridge] * (x.shape[1] - 1)), np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        change = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)),
                                 x.T @ (y - p) - penalty @ w)
        w = w + np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    return (rows.mapInArrow(_scores(model, raw=False), "doc_id long, score double")
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep_clean(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, with all their columns."""
    @F.arrow_udf("double")
    def toxic(texts: pa.Array) -> pa.Array:
        symbols, table = Symbols(model), GRAMMAR.table()
        found = np.array([features(t.as_py(), symbols, table) for t in texts], np.float64).reshape(-1, FEATURES)
        return pa.array(_probability(model, found))
    return docs.filter(toxic(whole_text(text_column)) < 0.5)
