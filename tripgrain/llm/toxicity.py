"""Toxicity of documents by a support vector machine on a subsequence string kernel.

The kernel of two strings counts their common subsequences of four letters, with up to two foreign
letters between, each occurrence weighted by `DECAY` to the power of their number. A word of letters put
apart by signs or blanks is read as one word; letters inserted into a word are the kernel's gaps.
A word of two or three letters, or three letters put apart, is read with a mark at either end, so that
it has subsequences as well; a single letter, or two put apart, is no word.

Landmark strings taken from the training words, as many as single out toxic documents, span the kernel's space (Nyström): a word is the
vector of its kernels with the landmarks, whitened by the landmarks' own kernel matrix. A document
is as toxic as its worst word, so training alternates between choosing each document's worst word
and fitting a linear machine with hinge loss on the chosen words. A logistic curve turns margins into
probabilities. The machine is linear in the kernel, so for scoring it is one table from subsequence
to weight.

The model is fitted to at most `MAX_LABELLED` labelled documents, those of the lowest hash of their
id; scores cover every row.

Defined results: NULL and empty texts have no words and get the probability of a document without
any toxic word; labels that are NULL are left out, contradicting ones all count; without both
classes every score is the share of toxic labels (0 without labels), likewise if no toxic document has
words; an empty table gives an empty result; rows with equal ids are scored
one by one; result columns replace input columns of the same name. Texts are read whole.
"""

from __future__ import annotations

import pickle
import re
from array import array
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.columns import bounded_broadcast, prepare_workers, whole_text, with_results

MAX_LABELLED = 4000
LETTERS, GAPS, DECAY = 4, 2, 0.6
FRAGMENT_LENGTHS = (4, 5, 6, 7)
NEAR_MISSES = 3
SHRINK, ROUNDS, CLOSE = 1e-4, 25, 0.02
MAX_CACHED_WORDS = 200_000
# Rows that are raised to double precision at a time.
BLOCK_ROWS = 16_384
LONGEST_WORD = 64

_SIGNS = re.compile(r"[\W_]+")
_REST = list(combinations(range(1, LETTERS + GAPS), LETTERS - 1))
_WEIGHTS = [DECAY ** (places[-1] + 1 - LETTERS) for places in _REST]
_PADDING = "\0" * (LETTERS + GAPS)
# Signs are taken out of words, so this stands in none.
_EDGE = "\x02"


def _with_edges(word: str) -> str:
    return word if len(word) >= LETTERS else f"{_EDGE}{word}{_EDGE}"


def units(text: str) -> set[str]:
    """The distinct words of a text, in lower case and without signs; short ones between marks.

    Runs of single letters also are read as one word, and very long words in overlapping parts.
    """
    found, letters = set(), []
    words = text.lower().split()
    for token in dict.fromkeys(words):
        word = token if token.isalnum() else _SIGNS.sub("", token)
        if len(word) > 1:
            found.add(_with_edges(word))
    if any(len(token) <= 3 for token in words):
        for token in [*words, _PADDING]:
            word = token if token.isalnum() else _SIGNS.sub("", token)
            if len(word) == 1:
                letters.append(word)
            elif word or token is _PADDING:
                if len(letters) >= 3:
                    found.add(_with_edges("".join(letters)))
                letters = []
    long = [word for word in found if len(word) > LONGEST_WORD]
    for word in long:
        found.remove(word)
        step = LONGEST_WORD - LETTERS - GAPS + 1
        found.update(word[at : at + LONGEST_WORD] for at in range(0, len(word), step))
    return found


def subsequences(word: str) -> dict[tuple[str, ...], float]:
    """All subsequences of `LETTERS` letters with at most `GAPS` gaps, with their weights."""
    padded, found = word + _PADDING, defaultdict(float)
    for at in range(len(word) - LETTERS + 1):
        window = padded[at + 1 : at + LETTERS + GAPS]
        for rest, weight in zip(combinations(window, LETTERS - 1), _WEIGHTS):
            if rest[-1] != "\0":
                found[(word[at], *rest)] += weight
    return found


class Landmarks:
    """Kernels of words with landmarks, and the whitening of the landmarks' kernel matrix."""

    def __init__(self, strings: list[str]):
        self.strings = strings
        spectra = [subsequences(string) for string in strings]
        self.entries: dict[tuple[str, ...], list[tuple[int, float]]] = defaultdict(list)
        for at, spectrum in enumerate(spectra):
            for letters, weight in spectrum.items():
                self.entries[letters].append((at, weight))
        gram = np.array([self.kernels(string) for string in strings])
        values, vectors = np.linalg.eigh(gram)
        kept = values > 1e-6 * values[-1]
        self.whitening = vectors[:, kept] / np.sqrt(values[kept])

    def kernels(self, word: str) -> np.ndarray:
        total = np.zeros(len(self.strings))
        for letters, weight in subsequences(word).items():
            for at, other in self.entries.get(letters, ()):
                total[at] += weight * other
        return total


def _fragments(word: str) -> set[str]:
    ends = {word[:n] for n in FRAGMENT_LENGTHS} | {word[-n:] for n in FRAGMENT_LENGTHS}
    return {word, *(end for end in ends if len(end) >= LETTERS)}


_NONE: frozenset[str] = frozenset()


def choose_landmarks(documents: list[list[str]], toxic: np.ndarray) -> list[str]:
    """Words, word starts and word ends that single out toxic documents.

    A piece is wanted if it is in so many toxic documents, after taking off those of other
    documents, that chance would not give one such piece among all. Of pieces that contain each
    other the one in the most documents is taken, the longest among equals. One with less than twice
    the documents that are needed is taken only if one of them has no piece taken before. If none is wanted, the
    best piece of all is; there is none if toxic documents have no words.
    """
    holders: Counter = Counter()
    plain: Counter = Counter()
    for at in np.flatnonzero(toxic).tolist():
        holders.update(set().union(*map(_fragments, documents[at])))
    # Pieces that no toxic document has are never wanted, and they are nearly all there are.
    known: dict[str, set[str]] = {}
    for at in np.flatnonzero(~toxic).tolist():
        seen: set[str] = set()
        for word in documents[at]:
            pieces = known.get(word)
            if pieces is None:
                pieces = known[word] = _fragments(word) & holders.keys() or _NONE
            seen |= pieces
        plain.update(seen)
    least = max(2.0, np.log(max(2, len(holders))) / -np.log(min(0.5, toxic.mean())))
    gains = {piece: times - 3 * plain[piece] for piece, times in holders.items()}
    by_gain = sorted(gains, key=lambda piece: (-gains[piece], -len(piece), piece))
    wanted = [piece for piece in by_gain if gains[piece] >= least] or by_gain[:1]
    held_by: dict[str, set[int]] = {piece: set() for piece in wanted}
    for at in np.flatnonzero(toxic).tolist():
        for piece in set().union(*map(_fragments, documents[at])) & held_by.keys():
            held_by[piece].add(at)
    chosen: list[str] = []
    explained: set[int] = set()
    for piece in wanted:
        if (gains[piece] >= 2 * least or held_by[piece] - explained) and not _alike(piece, chosen):
            chosen.append(piece)
            explained |= held_by[piece]
    return chosen


def near_misses(documents: list[list[str]], toxic: np.ndarray, marked: list[str]) -> list[str]:
    """The words of other documents that come closest to each toxic landmark.

    With them as landmarks too, what plain words share with an insult can be told from the rest.
    """
    landmarks = Landmarks(marked)
    own = np.array([landmarks.kernels(piece)[at] for at, piece in enumerate(marked)])
    best: list[list[tuple[float, str]]] = [[] for _ in marked]
    seen: set[str] = set()
    for at in np.flatnonzero(~toxic).tolist():
        for word in documents[at]:
            if word in seen:
                continue
            seen.add(word)
            near = landmarks.kernels(word) / own
            for place in np.flatnonzero(near > CLOSE).tolist():
                nearest = best[place]
                if len(nearest) < NEAR_MISSES or (near[place], word) > nearest[0]:
                    nearest.append((float(near[place]), word))
                    nearest.sort()
                    del nearest[: max(0, len(nearest) - NEAR_MISSES)]
    return sorted({word for nearest in best for _, word in nearest} - set(marked))


def _alike(piece: str, chosen: list[str]) -> bool:
    """True if a chosen piece is part of this one, or shares most of its letters in a row."""
    shared = max(LETTERS, len(piece) - 2)
    runs = [piece[at : at + shared] for at in range(max(1, len(piece) - shared + 1))]
    return any(other in piece or any(run in other for run in runs) for other in chosen)


def _stretched(word: str) -> list[str]:
    """The word with a foreign letter inserted, once at each inner place and once at two."""
    once = [f"{word[:at]}\x01{word[at:]}" for at in range(1, len(word))]
    return [*once, *(f"{part[:-2]}\x01{part[-2:]}" for part in once if len(word) > 5)]


@dataclass
class ToxicityModel:
    """Weights of subsequences by first letter, and the curve from margin to probability."""

    table: dict[str, dict[tuple[str, ...], float]]
    base: float
    slope: float
    offset: float

    def margin_of_word(self, word: str) -> float:
        padded, total = word + _PADDING, 0.0
        for at in range(len(word) - LETTERS + 1):
            rests = self.table.get(word[at])
            if rests:
                window = padded[at + 1 : at + LETTERS + GAPS]
                for rest, weight in zip(combinations(window, LETTERS - 1), _WEIGHTS):
                    value = rests.get(rest)
                    if value:
                        total += weight * value
        return total

    def probability(self, margin: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40))))


class WordMargins(dict):
    """Margins of words met so far. It starts anew when full, so its memory is bounded."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        margin = self[word] = self.model.margin_of_word(word)
        return margin


def _hinge(rows: np.ndarray, signs: np.ndarray, share: np.ndarray) -> np.ndarray:
    """A linear machine with squared hinge loss; the last weight is the bias.

    Newton steps: the rows inside the margin make a least squares problem, solved until it is the
    same rows, halving a step that does not lower the loss.
    """
    weights, shrink = np.zeros(rows.shape[1]), np.full(rows.shape[1], SHRINK)
    shrink[-1] = 1e-9

    def loss(at: np.ndarray) -> float:
        return float(share @ np.maximum(0.0, 1.0 - signs * (rows @ at)) ** 2 + shrink @ at**2)

    for _ in range(60):
        inside = signs * (rows @ weights) < 1.0
        weighed = rows[inside] * share[inside, None]
        goal = np.linalg.solve(weighed.T @ rows[inside] + np.diag(shrink), weighed.T @ signs[inside])
        step, before = 1.0, loss(weights)
        while step > 1e-3 and loss(weights + step * (goal - weights)) >= before:
            step /= 2
        if step <= 1e-3:
            break
        weights = weights + step * (goal - weights)
    return weights


def _platt(margins: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability, by Newton steps on smoothed targets."""
    high, low = (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2)
    target = np.where(toxic, high, low)
    state = np.array([1.0, 0.0])
    columns = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(100):
        chance = 1.0 / (1.0 + np.exp(-np.clip(columns @ state, -40, 40)))
        gradient = columns.T @ (chance - target) + 1e-3 * state
        curve = (columns * (chance * (1 - chance))[:, None]).T @ columns + 1e-3 * np.eye(2)
        state = state - np.clip(np.linalg.solve(curve, gradient), -1, 1)
    return float(state[0]), float(state[1])


def fit_machine(documents: list[list[str]], labels: list[int]) -> ToxicityModel:
    """Fit to documents given by their distinct words."""
    toxic = np.array(labels, bool)
    if toxic.all() or not toxic.any():
        share = float(toxic.mean()) if len(toxic) else 0.0
        return ToxicityModel({}, 0.0, 0.0, 40.0 if share == 1 else -40.0)
    marked = choose_landmarks(documents, toxic)
    if not marked:
        return ToxicityModel({}, 0.0, 0.0, float(np.log(toxic.mean() / (1 - toxic.mean()))))
    landmarks = Landmarks([*marked, *near_misses(documents, toxic, marked)])
    own = np.array([landmarks.kernels(piece)[at] for at, piece in enumerate(marked)])
    # Words that have next to nothing in common with a toxic landmark cannot be a document's worst.
    place: dict[str, int] = {}
    whitened, firsts = bytearray(), array("d")
    members, counts = array("q"), []
    for words in documents:
        before = len(members)
        for word in words:
            at = place.get(word)
            if at is None:
                vector = landmarks.kernels(word)
                held = vector[: len(marked)] / own
                at = place[word] = len(firsts) if (held > CLOSE).any() else -1
                if at >= 0:
                    row = np.append(vector @ landmarks.whitening, 1.0)
                    whitened += row.astype(np.float32).tobytes()
                    # To begin with, the worst word is the one that holds most of a toxic landmark.
                    firsts.append(held.max())
            if at >= 0:
                members.append(at)
        counts.append(len(members) - before)
    # The last row is a word without anything in common with a landmark; every document has it.
    width = landmarks.whitening.shape[1] + 1
    whitened += np.append(np.zeros(width - 1), 1.0).astype(np.float32).tobytes()
    rows = np.frombuffer(whitened, np.float32).reshape(-1, width)
    margins = np.append(np.array(firsts), 0.0)
    members, counts = np.array(members, np.int64), np.array(counts)
    bounds = np.cumsum(counts) - counts
    # The toxic landmarks are examples too, so that a rare or short one counts as much as a frequent
    # one; with letters inserted they count less, as plain words may come close to them.
    stretched = [shape for piece in marked for shape in _stretched(piece)]
    extra = np.array([landmarks.kernels(shape) for shape in [*marked, *stretched]])
    extra = extra.reshape(-1, len(landmarks.strings)) @ landmarks.whitening
    extra = np.hstack([extra, np.ones((len(extra), 1))])
    shares = [0.3 / toxic.sum(), 0.15 / len(marked), 0.05 / max(1, len(stretched))]
    positive = np.repeat(shares, [toxic.sum(), len(marked), len(stretched)])
    harmless = np.array([], np.int64)
    for _ in range(ROUNDS):
        worst = np.array(
            [
                max(members[low : low + n].tolist(), key=margins.__getitem__, default=-1)
                for low, n in zip(bounds, counts)
            ]
        )
        worst = np.where(margins[worst] > margins[-1], worst, -1)
        # Words of other documents stay examples once they were the worst, so none comes back.
        known = np.union1d(harmless, worst[~toxic])
        if len(known) == len(harmless):
            break
        harmless = known
        examples = np.vstack([rows[worst[toxic]], extra, rows[harmless]]).astype(float)
        signs = np.repeat([1.0, -1.0], [len(positive), len(harmless)])
        share = np.append(positive, np.full(len(harmless), 0.5 / len(harmless)))
        weights = _hinge(examples, signs, share)
        margins = np.concatenate(
            [rows[at : at + BLOCK_ROWS] @ weights for at in range(0, len(rows), BLOCK_ROWS)]
        )
    tops = np.array(
        [
            max(margins[members[low : low + n]].max(initial=-np.inf), margins[-1])
            for low, n in zip(bounds, counts)
        ]
    )
    slope, offset = _platt(tops, toxic)
    strengths = landmarks.whitening @ weights[:-1]
    table: dict[str, dict[tuple[str, ...], float]] = defaultdict(dict)
    for letters, entries in landmarks.entries.items():
        value = sum(strengths[at] * weight for at, weight in entries)
        table[letters[0]][letters[1:]] = float(value)
    return ToxicityModel(dict(table), float(weights[-1]), slope, offset)


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> ToxicityModel:
    """Fit to at most `max_labelled` labelled documents, chosen by the hash of their id."""
    prepare_workers(documents.sparkSession)
    known = labels.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")
    ).dropna()
    chosen = known.orderBy(F.xxhash64("id"), "id", "label").limit(max_labelled)
    texts = documents.select(F.col(f"`{id_column}`").alias("id"), whole_text(text).alias("text"))

    def extract(rows: pa.Array) -> pa.Array:
        found = [sorted(units(text.as_py())) for text in rows]
        return pa.array(found, type=pa.list_(pa.string()))

    words = F.arrow_udf(extract, "array<string>")(F.col("text"))
    found = texts.join(chosen, "id").select("label", F.col("id").cast("string"), words.alias("words"))
    labelled, documents = _shared_words(found.toArrow())
    order = sorted(range(len(labelled)), key=lambda at: (*labelled[at], documents[at]))
    return fit_machine([documents[at] for at in order], [labelled[at][1] for at in order])


def _shared_words(rows: pa.Table) -> tuple[list[tuple[str, int]], list[list[str]]]:
    """Ids with labels, and the words of each row, of which every distinct one is held once."""
    known: dict[str, str] = {}
    documents = [
        [known.setdefault(word, word) for word in words.as_py()]
        for chunk in rows.column("words").chunks
        for words in chunk
    ]
    return list(zip(rows.column("id").to_pylist(), rows.column("label").to_pylist())), documents


@lru_cache(maxsize=2)
def _loaded(payload: bytes) -> tuple[ToxicityModel, WordMargins]:
    model = pickle.loads(payload)
    return model, WordMargins(model)


def score_documents(
    documents: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score"
) -> DataFrame:
    """Documents with the probability that they are toxic."""
    shared = bounded_broadcast(documents.sparkSession, pickle.dumps(model))

    def score_batch(texts: pa.Array) -> pa.Array:
        loaded, margins = _loaded(shared.value)
        tops = [
            loaded.base + max(0.0, max(map(margins.__getitem__, units(text.as_py())), default=0.0))
            for text in texts
        ]
        return pa.array(map(loaded.probability, tops), type=pa.float64())

    scored = F.arrow_udf(score_batch, "double")(whole_text(text))
    return with_results(documents, {score: scored})
