"""Language of texts: script ranges narrow the candidates, Viterbi labels the words.

Training counts, over all documents with a known language that are not held out,
the letter sequences inside words (two to four letters, with the word's edges)
and the letters of each script. Sequences are hashed to ``BUCKETS`` places, so a
model is ``BUCKETS`` numbers a language however large the corpus is. Every task
counts its rows first; only those tables are shuffled and added up.

A text is cut into words, runs of letters of one script. A word's candidates are
the languages that write a share of their letters in its script (all, if none
does); the sequences' log-probabilities score it for each. Viterbi finds the
labels of all words with the best sum of scores less ``SWITCH`` for each change
of language, so a text of several languages falls into spans. The language with
most letters is the text's prediction, the share of its letters the score.

Defined results: a null text and one without letters are ``und`` with score 0 and
no spans; of languages with equally many letters the first by name counts; rows
that share an id, or repeat, are labelled each; a row without an id is labelled,
not held out and not learned from; without any training text all is ``und``.
A run of letters longer than ``PIECE`` is scored in parts. Languages beyond
``LANGUAGES`` are an error, as the model goes to every task. Other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierline.llm.scripts import NAMES, code_points, small_letters, words

#: Places for letter sequences, their sizes, and the languages a model may have.
BUCKETS, SIZES, LANGUAGES = 1 << 16, (2, 3, 4), 400
#: Letters of a language in a script, as a share, from which the script's words may be of that language.
SCRIPT_SHARE = 0.01
#: What a change of language costs, in units of log-probability; what a word of a foreign script costs.
SWITCH, FOREIGN = 12.0, 50.0
#: Letter sequences overlap, so a word's evidence is scaled down.
WEIGHT = 0.4
#: Characters scored at a time, and scores (words by languages) labelled at a time.
PIECE, TOGETHER = 1 << 19, 1 << 23
HELD_OUT_OF, HELD_OUT = 3, 1
UNKNOWN = "und"
_CHUNK = 1 << 10


def held_out(doc_id: Column | str) -> Column:
    """Whether a document takes no part in training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def sequences(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the letter sequences of the words, one array for each size, and where each word's begin.

    Words are laid out one after the other with a mark before and behind; a
    sequence is ``SIZES`` characters that lie in one word with its marks. Where
    none of a size begins the bucket is ``BUCKETS``.
    """
    lengths = ends - starts + 2
    number = np.arange(len(starts))
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    laid = np.full(int(lengths.sum()), 0x20, np.uint32)
    letters = np.arange(len(laid) - 2 * len(starts))
    laid[letters + np.repeat(2 * number + 1, lengths - 2)] = small_letters()[
        points[letters + np.repeat(starts - (firsts - 2 * number), lengths - 2)]]
    last = np.zeros(len(laid), bool)  # places whose sequence would leave the word
    last[firsts + lengths - 1] = True
    leaves, found = last.copy(), []
    rolling = laid * np.uint32(0x9E3779B1)
    for size in range(2, SIZES[-1] + 1):
        rolling = (rolling[:-1] ^ (rolling[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + laid[size - 1:]
        if size in SIZES:
            mixed = rolling * np.uint32(0xC2B2AE3D)
            places = np.full(len(laid), BUCKETS, np.int64)
            places[:len(mixed)] = (mixed ^ (mixed >> np.uint32(13))) >> np.uint32(32 - BUCKETS.bit_length() + 1)
            places[leaves] = BUCKETS
            found.append(places)
        leaves[:-1] |= leaves[1:].copy()
    return found, firsts


class _Counts:
    """Counts of one language in one task."""

    def __init__(self):
        self.places, self.scripts = np.zeros(BUCKETS, np.int64), np.zeros(len(NAMES), np.int64)

    def add(self, points: np.ndarray) -> None:
        starts, ends, kinds = words(points)
        if len(starts):
            found, _ = sequences(points, starts, ends)
            for places in found:
                self.places += np.bincount(places, minlength=BUCKETS + 1)[:BUCKETS]
            self.scripts += np.bincount(kinds, weights=ends - starts, minlength=len(NAMES)).astype(np.int64)


def pieces(text: str) -> Iterator[tuple[int, str]]:
    """The text in parts of about ``PIECE`` characters that end behind a word where they can."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end > at + 1 and text[end].isalpha() and text[end - 1].isalpha():
            end -= 1
        end = at + PIECE if end == at + 1 else end
        yield at, text[at:end]
        at = end
    yield at, text[at:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, _Counts] = {}
    for batch in batches:
        waiting: dict[str, list[str]] = {}
        for text, lang in zip(batch.column("text"), batch.column("lang")):
            waiting.setdefault(lang.as_py(), []).append(text.as_py())
        for lang, texts in waiting.items():
            counts = found.setdefault(lang, _Counts())
            for group in _grouped(texts):
                for _, part in pieces("\n".join(group)):
                    counts.add(code_points(part))
    rows = []
    for lang, counts in found.items():
        rows.append((lang, -1, counts.scripts))
        rows += [(lang, at // _CHUNK, counts.places[at:at + _CHUNK]) for at in range(0, BUCKETS, _CHUNK)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["lang", "chunk", "counts"])


def _grouped(texts: list[str]) -> Iterator[list[str]]:
    """The texts in groups of about ``PIECE`` characters."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > PIECE:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield group


def _added(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0
    for batch in group:
        names = batch.select(["lang", "chunk"]).slice(0, 1)
        total = total + batch.column("counts").flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0)
    yield pa.RecordBatch.from_arrays([*names.columns, pa.array([total], pa.list_(pa.int64()))],
                                     ["lang", "chunk", "counts"])


@dataclass(frozen=True)
class Model:
    """Log-probabilities (bucket by language, and a last row of zeros) and the candidates of each script."""

    languages: tuple[str, ...]
    places: np.ndarray
    candidates: np.ndarray


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model:
    """The model of all texts with a known language that are not held out."""
    known = (docs.filter(F.col(id_column).isNotNull() & ~held_out(id_column))
             .select(F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang"))
             .filter("text IS NOT NULL AND lang IS NOT NULL"))
    schema = "lang string, chunk int, counts array<long>"
    counted = known.mapInArrow(_count, schema).groupBy("lang", "chunk").applyInArrow(_added, schema)
    # At most LANGUAGES * BUCKETS numbers: the size of a model, whatever the corpus holds.
    rows = counted.limit(LANGUAGES * (BUCKETS // _CHUNK + 1) + 1).toArrow().to_pylist()
    languages = tuple(sorted({r["lang"] for r in rows}))
    if len(languages) > LANGUAGES or len(rows) > LANGUAGES * (BUCKETS // _CHUNK + 1):
        raise ValueError(f"More than {LANGUAGES} languages")
    places, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((len(NAMES), len(languages)))
    for row in rows:
        column, at = languages.index(row["lang"]), row["chunk"] * _CHUNK
        if at < 0:
            scripts[:, column] = row["counts"]
        else:
            places[at:at + _CHUNK, column] = row["counts"]
    smoothed = np.log(places + 0.5) - np.log(places.sum(axis=0) + 0.5 * BUCKETS)
    shares = scripts / np.maximum(scripts.sum(axis=0), 1)
    candidates = shares >= SCRIPT_SHARE
    candidates[~candidates.any(axis=1)] = True
    return Model(languages, np.vstack((WEIGHT * smoothed, np.zeros(len(languages)))).astype(np.float32), candidates)


def word_scores(model: Model, points: np.ndarray, starts, ends, kinds) -> np.ndarray:
    """Scores (word by language); those of languages that are no candidates are lowered."""
    found, firsts = sequences(points, starts, ends)
    evidence = model.places.take(found[0], axis=0)
    for places in found[1:]:
        evidence += model.places.take(places, axis=0)
    scores = np.add.reduceat(evidence, firsts, axis=0)
    # Relative to the best candidate, so long texts lose no digits.
    scores = np.where(model.candidates[kinds], scores, scores.min(axis=1, keepdims=True) - np.float32(FOREIGN))
    return scores - scores.max(axis=1, keepdims=True)


def viterbi(scores: np.ndarray, firsts: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word; sequences ``counts`` long begin at ``firsts`` and are independent.

    All sequences go forward together, longest first, so those that have ended
    are a tail that is cut off. Of equal sums staying wins, then the first label.
    """
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    firsts, counts = firsts[order], counts[order]
    labels, steps = np.zeros(len(scores), np.int32), int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(steps), side="left").tolist()  # sequences longer than the step
    moved, came = np.zeros(scores.shape, bool), np.zeros(len(scores), np.int32)
    last = np.zeros((len(order), scores.shape[1]), scores.dtype)
    label = np.zeros(len(order), np.int32)
    for step in range(steps):
        n, best = active[step], last[:active[step]]
        at = firsts[:n] + step
        if step:
            top = best.argmax(axis=1)
            # Sums are relative to the best one, so that is zero.
            moved[at], came[at] = best < -switch, top
            np.maximum(best, -switch, out=best)
        best += scores[at]
        best -= best.max(axis=1, keepdims=True)
        over = active[step + 1] if step + 1 < steps else 0
        if over < n:
            label[over:n] = best[over:].argmax(axis=1)
    for step in range(steps - 1, -1, -1):
        n = active[step]
        at, now = firsts[:n] + step, label[:n]
        labels[at] = now
        if step:
            gone = moved[at, now]
            if gone.any():
                label[:n] = np.where(gone, came[at], now)
    return labels


class _Words:
    """Words of several texts with their scores, waiting to be labelled together."""

    def __init__(self, model: Model):
        self.model, self.starts, self.ends, self.scores, self.counts = model, [], [], [], []

    def add(self, texts: list[str]) -> None:
        """Short texts, scored together, or a single one of any length."""
        if len(texts) > 1:
            points = code_points("\n".join(texts))
            begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
            starts, ends, kinds = words(points)
            counts = np.diff(np.searchsorted(starts, begins))
            self._score(points, starts, ends, kinds, np.repeat(begins[:-1], counts))
            self.counts += counts.tolist()
        else:
            self.counts.append(0)
            for at, part in pieces(texts[0]):
                points = code_points(part)
                starts, ends, kinds = words(points)
                self._score(points, starts, ends, kinds, -at)
                self.counts[-1] += len(starts)

    def _score(self, points, starts, ends, kinds, before) -> None:
        self.starts.append(starts - before)
        self.ends.append(ends - before)
        if len(starts):
            self.scores.append(word_scores(self.model, points, starts, ends, kinds))

    @property
    def size(self) -> int:
        return sum(map(len, self.scores)) * len(self.model.languages)

    def labelled(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Starts, ends and labels of the words of each text."""
        firsts = np.concatenate(([0], np.cumsum(self.counts))).astype(np.int64)
        labels = np.zeros(0, np.int32)
        if self.scores:
            labels = viterbi(np.concatenate(self.scores), firsts[:-1], np.diff(firsts))
        starts, ends = np.concatenate(self.starts), np.concatenate(self.ends)
        for a, b in zip(firsts[:-1], firsts[1:]):
            yield starts[a:b], ends[a:b], labels[a:b]


def _label(model: Model, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Starts, ends and labels of the words of each text, about ``TOGETHER`` scores at a time."""
    if not model.languages:
        yield from ((np.zeros(0, np.int64),) * 3 for _ in texts)
        return
    waiting = _Words(model)
    for group in _grouped(texts):
        waiting.add(group)
        if waiting.size >= TOGETHER:
            yield from waiting.labelled()
            waiting = _Words(model)
    if waiting.counts:
        yield from waiting.labelled()


def _spans(model: Model, shared):
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            predicted, shares, begins, stops, langs = [], [], [], [], []
            texts = [t.as_py() or "" for t in batch.column("text")]
            for starts, ends, labels in _label(model, texts):
                letters = np.bincount(labels, weights=ends - starts, minlength=len(model.languages) or 1)
                total = letters.sum()
                predicted.append(model.languages[int(letters.argmax())] if total else UNKNOWN)
                shares.append(float(letters.max() / total) if total else 0.0)
                edges = np.flatnonzero(np.diff(labels)) + 1
                begins.append(starts[np.concatenate(([0], edges))] if total else starts)
                stops.append(ends[np.concatenate((edges - 1, [len(ends) - 1]))] if total else ends)
                langs.append([model.languages[k] for k in labels[np.concatenate(([0], edges))]] if total else [])
            longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(predicted, pa.string()),
                 pa.array(shares, pa.float64()), pa.array(begins, longs), pa.array(stops, longs), pa.array(langs, strings)],
                ["doc_id", "held_out", "lang_pred", "score", "starts", "ends", "langs"])
    return spans


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score and spans (start, end, lang) of every row, by its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(id_column).alias("held_out"),
                       F.col(text_column).cast("string").alias("text"))
    found = rows.mapInArrow(_spans(model, shared), "doc_id long, held_out boolean, lang_pred string, score double,"
                            " starts array<long>, ends array<long>, langs array<string>")
    zipped = F.arrays_zip("starts", "ends", "langs")
    spans = F.transform(zipped, lambda s: F.struct(s["starts"].alias("start"), s["ends"].alias("end"), s["langs"].alias("lang")))
    return found.select("doc_id", "held_out", "lang_pred", "score", spans.alias("spans"))
