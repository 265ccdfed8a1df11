"""Reading level of each English prose document (problem 8).

A Rasch-style latent model in its ideal-point form: document d has a level t_d, and word w's log odds among the words that occur at level t
are ``a_w + b_w t - c_w t^2``: a curve with its top at the word's difficulty ``b_w / 2 c_w``. (The monotone Rasch curve, c_w = 0, can't hold
alone: easy words become rarer as texts become harder.) Given the number of its different words, a document's words have the likelihood
``sum(a_w + b_w t - c_w t^2) - n log Z(t)``, where Z sums over all words, those that don't occur included. It is maximised, with a normal prior
on b_w and c_w that keeps rare words flat, by alternating two steps over all documents:

* documents: t_d is the maximum of its likelihood, which is three sums over its words and the curve log Z, known on a grid of levels;
* words: Newton steps on a_w, b_w, c_w from three distributed sums for each word (documents, their levels, squared levels) and one histogram
  of the words at each level, from which the expected sums follow.

Rounds end when the log likelihood of a word changes by less than ``gain``, after ``rounds`` at the latest. Documents graded by readers are held at their grade; since such a scale
can be stretched and shifted without changing the likelihood, after each round a line is fitted that brings the graded documents' own
estimates onto their grades. Levels are cut midway between the graded documents of neighbouring grades.

Words are hashed to ``2**bits`` slots. That bounds what is sent to tasks and gathered at the driver (three numbers a slot) whatever the
corpus. Where a corpus has more words than slots, words share them: a million words share ``2**18`` slots by four, most of them words of few
documents, which weigh little beside the frequent word of the slot, if there is one (README has a measurement).
Texts are tokenised once; the slots of eligible documents are checkpointed in the cluster's shared folder and all rounds read them.
The grades are a small table; at most ``most_graded`` are used, those of the smallest ids (a documented bound; more would only sharpen the
scale).

Eligible are documents whose greater part is prose (as in ``quality``), in blocks whose function words are English, with ``least_words``
words or more of it.

Defined results for odd input: null, blank or foreign texts and texts without enough prose have no row; a repeated document has a row for
each time it stands there; grades of unknown or ineligible documents are ignored; null grades too; a document of numbers only has no row;
without any usable grade the result is empty, as there is no scale.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.batches import map_columns
from leafgraph.llm.quality import block_kind
from leafgraph.llm.words import FUNCTION_WORDS, WORD, language_scores
from leafgraph.sources.tables import checkpointed

_ENGLISH = list(FUNCTION_WORDS).index("en")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-‐‑¬­]\s*\n\s*(?=[^\W\d_])")
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n")


def english_prose(text: str | None, least_words: int = 80) -> list[str] | None:
    """The words of the English prose of a text, or None if it isn't mainly that or too short."""
    if not text:
        return None
    stats: Counter = Counter()
    words: list[str] = []
    mine = 0
    for part in _PARAGRAPH.split(text):
        lines = [x for x in part.splitlines() if x.strip()]
        if not lines:
            continue
        before = stats["prose_chars"]
        if block_kind(lines, stats) != "prose":
            continue
        own = WORD.findall(_BROKEN.sub("", part).lower())
        scores = language_scores(own)
        if scores[_ENGLISH] * 8 >= len(own) and scores[_ENGLISH] == max(scores):
            words += own
            mine += stats["prose_chars"] - before
    total = sum(stats[f"{k}_chars"] for k in ("prose", "list", "table", "junk"))
    return words if len(words) >= least_words and mine * 2 >= total else None


def _slots(docs: DataFrame, doc_id: str, text: str, bits: int, least_words: int) -> DataFrame:
    mask = (1 << bits) - 1

    def make():
        slot = lru_cache(1 << 18)(lambda w: zlib.crc32(w.encode()) & mask)

        def run(ids, texts):
            out = [(i, sorted({slot(w) for w in words if not w.isdigit()})) for i, t in zip(ids, texts) if (words := english_prose(t, least_words))]
            return {"doc_id": [o[0] for o in out], "slots": [o[1] for o in out]}

        return run

    return map_columns(docs, {"i": F.col(doc_id).cast("long"), "t": text}, make, "doc_id long, slots array<int>")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(), offsets


class Scale:
    """The words' curves, log Z on a grid of levels, and the line that brings estimates onto the grades."""

    def __init__(self, size: int, low: float, high: float, points: int = 97):
        self.a = np.full(size, -np.inf, np.float32)
        self.b, self.c = np.zeros(size, np.float32), np.zeros(size, np.float32)
        self.middle = (low + high) / 2
        self.grid = np.linspace(low, high, points) - self.middle
        self.log_z = np.zeros(points)
        self.slope, self.shift = 1.0, 0.0

    def __getstate__(self) -> dict:
        """Only the known words are sent to the tasks."""
        at = np.flatnonzero(np.isfinite(self.a)).astype(np.int32)
        return {**self.__dict__, "a": (len(self.a), at, self.a[at]), "b": self.b[at], "c": self.c[at]}

    def __setstate__(self, state: dict) -> None:
        size, at, a = state["a"]
        self.__dict__.update(state)
        self.a = np.full(size, -np.inf, np.float32)
        self.b, self.c = np.zeros(size, np.float32), np.zeros(size, np.float32)
        self.a[at], self.b[at], self.c[at] = a, state["b"], state["c"]

    def learn(self, slots: np.ndarray, n: np.ndarray, s1: np.ndarray, s2: np.ndarray, words_at: np.ndarray, prior: float, steps: int = 4) -> None:
        """Words step: Newton steps for the words of these sums (documents, levels and squared levels from the middle); ``words_at``: words at each level of the grid."""
        fresh = ~np.isfinite(self.a[slots])
        self.a[slots[fresh]] = np.log(n[fresh] / n.sum())
        powers = np.stack((np.ones_like(self.grid), self.grid, -(self.grid**2)))
        for _ in range(steps):
            self._normalize(slots)
            weight = words_at * np.exp(-self.log_z)
            for lo in range(0, len(slots), 1 << 15):
                at = slots[lo : lo + (1 << 15)]
                theta = np.stack((self.a[at], self.b[at], self.c[at]), 1).astype(np.float64)
                expected = np.exp(theta @ powers) * weight  # of each word at each level
                pull = np.array([0.0, prior, prior])
                seen = np.stack((n[lo : lo + len(at)], s1[lo : lo + len(at)], -s2[lo : lo + len(at)]), 1)
                gradient = seen - expected @ powers.T - pull * theta
                curvature = np.einsum("wg,ig,jg->wij", expected, powers, powers) + np.diag(pull + 1e-6)
                theta += np.clip(np.linalg.solve(curvature, gradient[:, :, None])[:, :, 0], -1.0, 1.0)
                self.a[at], self.b[at], self.c[at] = theta[:, 0], theta[:, 1], np.clip(theta[:, 2], 0.0, 16.0)
        self._normalize(slots)

    def _normalize(self, slots: np.ndarray) -> None:
        z = np.zeros(len(self.grid))
        for lo in range(0, len(slots), 1 << 15):
            at = slots[lo : lo + (1 << 15)]
            z += np.exp(self.a[at, None] + self.b[at, None] * self.grid - self.c[at, None] * self.grid**2).sum(0)
        self.log_z = np.log(z)

    def anchor(self, own: np.ndarray, grades: np.ndarray) -> None:
        ok = np.isfinite(own)
        own, grades = own[ok], grades[ok]
        if len(own) > 1 and np.ptp(own) > 1e-9 and np.ptp(grades) > 0:
            self.slope, self.shift = np.polyfit(own, grades, 1)
        else:
            self.slope, self.shift = 1.0, float(grades.mean() - own.mean()) if len(own) else 0.0

    def own_levels(self, values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents step: each document's level before the line, its log likelihood there and its known words; NaN without any."""
        known = np.isfinite(self.a[values])
        sums = []
        for x in (known, np.where(known, self.a[values], 0.0), np.where(known, self.b[values], 0.0), np.where(known, self.c[values], 0.0)):
            total = np.concatenate(([0.0], np.cumsum(x, dtype=np.float64)))
            sums.append(total[offsets[1:]] - total[offsets[:-1]])
        n, a, b, c = sums
        g = self.grid
        surface = b[:, None] * g - c[:, None] * g**2 - n[:, None] * self.log_z
        top = np.clip(surface.argmax(1), 1, len(g) - 2)
        rows = np.arange(len(n))
        left, mid, right = (surface[rows, top + k] for k in (-1, 0, 1))
        bend = left - 2 * mid + right
        with np.errstate(invalid="ignore", divide="ignore"):
            step = np.where(bend < 0, np.clip((left - right) / (2 * bend), -1, 1), 0.0)  # top of the parabola through the three
        t = np.where(n > 0, self.middle + g[top] + step * (g[1] - g[0]), np.nan)
        return t, a + surface.max(1, initial=-np.inf), n

    def estimate(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.slope * self.own_levels(values, offsets)[0] + self.shift


_LIKELIHOOD = -1  # below it the levels of the grid


def _word_sums(docs: DataFrame, scale: Scale, grades: dict[int, int]) -> tuple[tuple[np.ndarray, ...], np.ndarray, float]:
    """Documents step over all documents: sums for each slot, words at each level, and the log likelihood of a word. Dense per task, so
    tasks send at most a row a slot."""
    shared = docs.sparkSession.sparkContext.broadcast(scale)

    def run(batches):
        scale = shared.value
        size, points = len(scale.a), len(scale.grid)
        n, s1, s2, at_level = np.zeros(size), np.zeros(size), np.zeros(size), np.zeros(points)
        gain = words = 0.0
        for batch in batches:
            values, offsets = _flat(batch.column(1))
            own, likelihood, known = scale.own_levels(values, offsets)
            t = np.clip(scale.slope * own + scale.shift - scale.middle, scale.grid[0], scale.grid[-1])
            for k, i in enumerate(batch.column(0).to_pylist()):
                if i in grades:
                    t[k] = grades[i] - scale.middle
            ok = known > 0
            gain += float(likelihood[ok].sum())
            words += float(known[ok].sum())
            size_of = np.diff(offsets)
            ok = np.isfinite(t)
            place = np.where(ok, (t - scale.grid[0]) / (scale.grid[1] - scale.grid[0]), 0.0)
            low = np.clip(place.astype(np.int64), 0, points - 2)
            at_level += np.bincount(low, np.where(ok, size_of * (1 - place + low), 0.0), points) + np.bincount(low + 1, np.where(ok, size_of * (place - low), 0.0), points)
            per = np.repeat(t, size_of)
            v = values[offsets[0] : offsets[-1]]
            ok = np.isfinite(per)
            v, per = v[ok], per[ok]
            n += np.bincount(v, minlength=size)
            s1 += np.bincount(v, per, size)
            s2 += np.bincount(v, per * per, size)
        at = np.flatnonzero(n)
        slot = np.concatenate((at, _LIKELIHOOD - 1 - np.arange(points), [_LIKELIHOOD])).astype(np.int32)
        nothing = np.zeros(points)
        yield pa.RecordBatch.from_arrays([pa.array(slot), *(pa.array(np.concatenate((x[at], y, [z]))) for x, y, z in ((n, at_level, gain), (s1, nothing, words), (s2, nothing, 0.0)))], ["slot", "n", "s1", "s2"])

    sums = docs.mapInArrow(run, "slot int, n double, s1 double, s2 double").groupBy("slot").agg(F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))
    got = sums.toArrow()
    shared.destroy()
    slot, n, s1, s2 = (got.column(c).to_numpy() for c in ("slot", "n", "s1", "s2"))
    levels, word = slot < _LIKELIHOOD, slot >= 0
    words_at = np.zeros(len(scale.grid))
    words_at[_LIKELIHOOD - 1 - slot[levels]] = n[levels]
    one = slot == _LIKELIHOOD
    return tuple(x[word] for x in (slot, n, s1, s2)), words_at, float(n[one].sum() / max(s1[one].sum(), 1.0))


def fit_levels(slots: DataFrame, labels: DataFrame, doc_id: str, level: str, rounds: int, gain: float, prior: float, bits: int, most_graded: int) -> tuple[Scale, list[tuple[int, float]]] | None:
    """The scale, and the lowest estimate of each level; None without grades."""
    rows = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(level).cast("int").alias("level")).dropna().orderBy("doc_id", "level").limit(most_graded).collect()
    grades = {r.doc_id: r.level for r in rows}
    if not grades:
        return None
    graded = slots.filter(F.col("doc_id").isin(list(grades))).dropDuplicates(["doc_id"]).collect()
    if not graded:
        return None
    lists = [np.array(r.slots, np.int32) for r in graded]
    values, offsets = np.concatenate(lists), np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    y = np.array([grades[r.doc_id] for r in graded], float)
    scale = Scale(1 << bits, y.min() - 0.75, y.max() + 0.75)
    at, inverse = np.unique(values, return_inverse=True)
    per = np.repeat(y - scale.middle, np.diff(offsets))
    place = np.repeat(np.abs(scale.grid[None, :] - (y - scale.middle)[:, None]).argmin(1), np.diff(offsets))
    scale.learn(at, *(np.bincount(inverse, x) for x in (np.ones_like(per), per, per * per)), np.bincount(place, minlength=len(scale.grid)).astype(float), prior)
    scale.anchor(scale.own_levels(values, offsets)[0], y)
    before = -np.inf
    for k in range(rounds):
        sums, words_at, likelihood = _word_sums(slots, scale, grades)
        if k > 1 and abs(likelihood - before) < gain:  # the first round knows the words of graded documents only
            break
        before = likelihood
        scale.learn(*sums, words_at, prior)
        scale.anchor(scale.own_levels(values, offsets)[0], y)
    return scale, cut_points(scale.estimate(values, offsets), y.astype(int))


def cut_points(estimates: np.ndarray, grades: np.ndarray) -> list[tuple[int, float]]:
    """Levels with their lowest estimate: midway between the inner edges of neighbouring grades, or of their medians where they overlap."""
    levels = sorted(set(grades.tolist()))
    cuts = [(levels[0], -np.inf)]
    for a, b in zip(levels, levels[1:]):
        lower, upper = estimates[grades == a], estimates[grades == b]
        edge = (lower.max() + upper.min()) / 2 if lower.max() < upper.min() else (np.median(lower) + np.median(upper)) / 2
        cuts.append((b, float(edge)))
    return cuts


def reading_levels(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", level: str = "reading_level", least_words: int = 80, rounds: int = 12, gain: float = 2e-3, prior: float = 2.0, bits: int = 18, most_graded: int = 100_000) -> DataFrame:
    """Rows (doc_id, reading_level, difficulty): level on the scale of the grades, and the latent estimate before it is cut."""
    slots = checkpointed(_slots(docs, doc_id, text, bits, least_words).filter(F.size("slots") > 0))
    fitted = fit_levels(slots, labels, label_id, level, rounds, gain, prior, bits, most_graded)
    if fitted is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, reading_level int, difficulty double")
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches):
        scale, cuts = shared.value
        names, edges = np.array([c[0] for c in cuts], np.int32), np.array([c[1] for c in cuts])
        for batch in batches:
            t = scale.estimate(*_flat(batch.column(1)))
            at = np.maximum(np.searchsorted(edges, t, side="right") - 1, 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[at]), pa.array(t)], ["doc_id", "reading_level", "difficulty"])

    return slots.mapInArrow(run, "doc_id long, reading_level int, difficulty double")


def level_profile(levels: DataFrame) -> DataFrame:
    """Documents and mean latent difficulty of each level."""
    return levels.groupBy("reading_level").agg(F.count("*").alias("documents"), F.avg("difficulty").alias("mean_difficulty"))
