"""Noise in text from scanned pages: words parted at line ends, misread letters, running headers and page numbers (problem 2).

1. *Words.* One pass over the distinct texts counts every lower-case word, and the hashed words to its left and right. From these come the
   skip-gram vectors: the words' mutual information with the 2 x 128 buckets, which training with negative sampling factorises, is
   factorised by its leading eigenvectors. The 256 x 256 matrix that they come from is a distributed sum; a word's vector is its row
   times the eigenvectors, and a bucket's vector is its row of them. Tasks send one row a word; vectors stay distributed. Words that make up at least ``lexicon_share`` of all (so at most 1 / lexicon_share of them)
   are the lexicon, the only thing besides 256 bucket totals that goes to the driver and the tasks. Misreadings of words below that share
   are found by an equality join of glyph variants with the counted words, from ``ratio`` occurrences on whatever the size of the corpus.
2. *Lines.* A second pass over the texts gives narrow rows only: one a region with its first lines and its last line, parted words, and words
   outside the lexicon with the lexicon words that plausible glyph edits lead to. Text is shuffled once only, to count copies of a text once in pass 1.
3. *Furniture.* A top line is a running header if one of its keys (case and confusable glyphs folded; numbers at its ends left out if they
   go with the page) stands at the top of another page of the document. A line with only a number is a page number if its style says so or its distance to the page's
   position is that of another page. Both are grouped by (document, skeleton) or (document, distance) with partial aggregation.
4. *Parted words* are joined; a compound keeps its hyphen if the lexicon knows it with it. A region that ends in a parted word is joined
   with the next text of its document that begins inside a sentence, found in one sort by document.
5. *Misread words.* A rare word is linked to frequent neighbours ``ratio`` times as frequent; among several the context decides: the sum of
   log frequency and the products of the neighbour's vector with those of the words left and right.

Defined results for odd input: null and blank texts give nothing; regions delivered again give their own rows and count as one place;
null page or node numbers are places before all others; a text of any length is read whole; ties between neighbours go to the more
frequent, then to the first in the alphabet; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache
from hashlib import blake2b
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafgraph.llm.batches import map_columns
from leafgraph.llm.quality import block_kind
from leafgraph.llm.words import FUNCTION_WORDS
from leafgraph.operators.components import components
from leafgraph.sources.tables import written

BUCKETS = 128  # for each side
_HYPHENS = "-‐‑¬­"
_WORD = re.compile(r"[^\W_]+")
_TOKEN = re.compile(r"[^\W_]+(?:-[^\W_]+)*")
#: A hyphen between letters with a line end behind it. The hyphen stands first in the pattern: the search then skips from sign to sign.
_BREAK = re.compile(rf"[{_HYPHENS}](?<=[^\W\d_].)[^\S\n]*\n\s*(?=[^\W\d_])")
_LEFT = re.compile(r"(?:[^\W_]+-)*[^\W_]*[^\W\d_]\Z")
_RIGHT = re.compile(r"[^\W\d_][^\W_]*(?:-[^\W_]+)*")
_COMMON = frozenset(w for words in FUNCTION_WORDS.values() for w in words)

# What is read, and what may have been written.
GLYPHS = (
    "c e|e c|l i|i l|f t|t f|o a|a o|ri n|n ri|0 o|1 l|1 i|cl d|d cl|5 s|rn m|m rn|9 g|ii u|u ii|b h|h b|6 b|8 b|vv w|w vv|2 z|li h|nn m|in m|ni m|q g|g q|iv w|u v|v u"
).split("|")
_UNDO: dict[str, list[str]] = {}
for _pair in GLYPHS:
    _read, _right = _pair.split(" ")
    _UNDO.setdefault(_read, []).append(_right)


def glyph_neighbours(word: str, known, edits: int = 1) -> list[str]:
    """Known words that the word may be a misreading of: up to ``edits`` confusions undone, fewest first."""
    tier, seen = {word}, {word}
    for _ in range(edits):
        nxt = set()
        for w in tier:
            for i in range(len(w)):
                for size in (1, 2):
                    for right in _UNDO.get(w[i : i + size], ()) if i + size <= len(w) else ():
                        v = w[:i] + right + w[i + size :]
                        if v not in seen:
                            nxt.add(v)
        seen |= nxt
        hits = sorted(v for v in nxt if v in known)
        if hits:
            return hits
        tier = nxt
    return []


# --- furniture ----------------------------------------------------------------------------------------------------------------------
_ROMAN = re.compile(r"(?=[mdclxvi])m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})")
_DIGITS = str.maketrans("lIi|oOsSzZBg", "111100552289")
_NUMBER = r"[0-9lIi|oOsSzZBg]{1,4}|[mdclxvi]{1,7}|[MDCLXVI]{1,7}"
_PAGE_STYLED = re.compile(rf"\W*(?:pages?|pag|pg|p|seite|página|folio|fol|sheet|blatt|s)\W{{0,3}}\s*({_NUMBER})(?:\s*(?:of|/|von|de|sur)\s*(?:{_NUMBER}))?\W*", re.I)
_PAGE_OF = re.compile(rf"\W*({_NUMBER})\s*(?:of|/|von|de|sur)\s*(?:{_NUMBER})\W*")
_PAGE_BARE = re.compile(rf"([^\w\s]*)\s*({_NUMBER})\s*([^\w\s]*)")


def _value(text: str) -> int | None:
    """Number of a page, in digits (some maybe misread) or Roman."""
    low = text.lower()
    if _ROMAN.fullmatch(low) and not low.isdigit():
        total = last = 0
        for ch in reversed(low):
            v = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}[ch]
            total, last = (total - v, last) if v < last else (total + v, v)
        return total if not (low == "l" or low == "c") else 1 if low == "l" else total
    t = text.translate(_DIGITS)
    return int(t) if t.isdigit() else None


def page_number(line: str) -> tuple[int, bool] | None:
    """Value of a line that holds nothing but a page's number, and whether its style says so (words, dashes, brackets)."""
    line = line.strip()
    if not line or len(line) > 24:
        return None
    m = _PAGE_STYLED.fullmatch(line) or _PAGE_OF.fullmatch(line)
    if m:
        v = _value(m[1])
        return None if v is None else (v, True)
    m = _PAGE_BARE.fullmatch(line)
    if not m or bool(m[1]) != bool(m[3]) or not (any(map(str.isdigit, m[2])) or _ROMAN.fullmatch(m[2].lower()) or m[1]):
        return None
    v = _value(m[2])
    return None if v is None else (v, bool(m[1]) and m[1][0] not in "$€£+")


# Glyphs that are read for each other, as one sign of a skeleton; a glyph that falls apart is written as its parts.
_SAME = {"o": "0aec", "i": "1lt|f", "s": "5", "g": "9q", "b": "68h", "z": "2"}
_PARTS = {"d": "oi", "n": "ri", "m": "rri", "w": "vv", "u": "ii"}
_FOLD = str.maketrans({x: k for k, v in _SAME.items() for x in v} | _PARTS)
_AT_ENDS = re.compile(rf"^(?:\W*(?:{_NUMBER})\W*\s{{2,}})|(?:\s{{2,}}\W*(?:{_NUMBER})\W*)$")
_CELLS = re.compile(r"\t|\||\S {4,}\S")


def _celled(line: str) -> bool:
    return "\t" in line or "|" in line or ("    " in line and _CELLS.search(line) is not None)


def skeleton(line: str) -> str | None:
    """What a header keeps from page to page; None for lines that can't be one."""
    line = line.strip()
    if "  " in line:
        line = _AT_ENDS.sub(" ", line).strip()
    if not 6 <= len(line) <= 120 or line[-1] in ".!?;,:" or " " not in line or _celled(line):
        return None
    low = _folded(line)
    return low if len(low) >= 5 else None


def _folded(line: str) -> str:
    if not line.isascii():
        return "".join(_WORD.findall(line.replace("F", "E").lower().translate(_FOLD)))
    low = line.encode().translate(_ASCII_FOLD, _ASCII_GONE)
    for whole, parts in _ASCII_PARTS:
        low = low.replace(whole, parts)
    return low.decode()


# The same for ASCII signs, by tables of bytes: the signs that are dropped, those that stand for one sign, those written as their parts.
_ASCII_GONE = bytes(c for c in range(128) if not _WORD.search(chr(c).lower().translate(_FOLD)))
_ASCII_FOLD = bytes(ord(low.translate(_FOLD) if low not in _PARTS else low) if c < 128 and c not in _ASCII_GONE else c for c in range(256) for low in [chr(c).replace("F", "E").lower()])
_ASCII_PARTS = tuple((k.encode(), v.encode()) for k, v in _PARTS.items())


_PAGE_WORD = r"(?:pages?|pag|pg|p|seite|página|folio|fol|sheet|blatt|s)\W{0,3}"
_NUMBERED = rf"(?P<word>{_PAGE_WORD})?(?P<num>{_NUMBER})(?:\s*(?:of|/|von|de|sur)\s*(?:{_NUMBER}))?"
_STARTS = re.compile(rf"\A\W*{_NUMBERED}[\W_]+", re.I)
_ENDS = re.compile(rf"[\W_]+{_NUMBERED}\W*\Z", re.I)


_MAY_START = re.compile(rf"{_PAGE_WORD}|(?:{_PAGE_WORD})?(?:{_NUMBER})", re.I)
_MAY_END = re.compile(rf"(?:{_PAGE_WORD})?(?:{_NUMBER})", re.I)


@lru_cache(1 << 16)
def _may_number(word: str) -> tuple[bool, bool]:
    """Whether a number may begin with the word at the start of a line, and end with it at the end."""
    word = word.strip(punctuation)
    return not word.isalpha() or _MAY_START.fullmatch(word) is not None, not word.isalpha() or _MAY_END.fullmatch(word) is not None


def header_keys(line: str, page: int) -> list[str]:
    """Keys, one of which a top line shares with its returns on other pages: its skeleton, all its signs folded, and without a number at
    either end. Such a number is part of the key by its distance to the page, so captions counted on their own don't meet; behind a page
    word it is the page's number anyway."""
    line = line.strip()
    keys = [skeleton(line)] if "  " in line else []  # else it is the folded line
    if not _celled(line):
        keys.append(_folded(line))
    starts = _STARTS.match(line) if _may_number(line.split(None, 1)[0])[0] else None
    ends = _ENDS.search(line, max(0, len(line) - 120)) if _may_number(line.rsplit(None, 1)[-1])[1] else None
    for m in (starts, ends):
        if not m:
            continue
        rest = (line[: m.start()] + line[m.end() :]).strip()
        if not rest or _celled(rest) or not (low := _folded(rest)) or (value := _value(m["num"])) is None:
            continue
        keys.append(low if m["word"] and any(map(str.isdigit, m["num"])) else f"{low}#{value - page}")
    return [k if len(k) <= 60 else blake2b(k.encode(), digest_size=16).hexdigest() for k in dict.fromkeys(keys) if k]


# --- words --------------------------------------------------------------------------------------------------------------------------
def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) & (BUCKETS - 1)


# For ASCII text: a hyphen that doesn't stand between letters or digits, and all other signs but those as blanks.
_STRAY = re.compile(r"-(?:(?<![0-9A-Za-z]-)|(?![0-9A-Za-z]))")
_BLANKS = bytes(c if chr(c).isalnum() or c == ord("-") or c > 127 else 32 for c in range(256))


def _tokens(text: str) -> list[str]:
    """All matches of _TOKEN; in ASCII text by splitting at blanks, which takes a fraction of the time."""
    if not text.isascii():
        return _TOKEN.findall(text)
    if "-" in text:
        text = _STRAY.sub(" ", text)
    return text.encode().translate(_BLANKS).decode().split()


def _may_part(text: str) -> bool:
    return "-" in text or not text.isascii()


def plain_words(text: str) -> list[str]:
    """Tokens with parted words joined, so that halves don't count as words."""
    return _tokens(_BREAK.sub("", text) if _may_part(text) else text)


def parted(text: str) -> list[tuple[int, str, str]]:
    """Where a word is parted at a line end, and its halves."""
    out = []
    if not _may_part(text):
        return out
    for m in _BREAK.finditer(text):
        left = _LEFT.search(text, max(0, m.start() - 80), m.start())
        if left and not left[0][0].isdigit():
            out.append((m.start(), left[0], _RIGHT.match(text, m.end())[0]))
    return out


class _Ids(dict):
    """Numbers of tokens as they stand: lower-case words have one each, other words a context-only number, plain numbers none (0)."""

    def __init__(self):
        self.names = [""]
        self.buckets = [_bucket("")]
        self.at: dict[str, int] = {}

    def __missing__(self, token: str) -> int:
        if token.islower():
            key = token
        elif token.isdigit():
            self[token] = 0
            return 0
        else:
            key = token.lower() + "\x00"
        i = self.at.get(key)
        if i is None:
            i = self.at[key] = len(self.names)
            self.names.append(key)
            self.buckets.append(_bucket(key.rstrip("\x00")))
        self[token] = i
        return i


class _Learner:
    """Counts and context counts of the words of one task; flushed when they grow large, so memory is bounded."""

    def __init__(self, most: int = 200_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.ids = _Ids()
        self.codes: list[np.ndarray] = []
        self.cells = np.empty(0, np.int64), np.empty(0, np.int64)
        self.counts = np.zeros(1, np.int64)
        self.pending = 0

    def __call__(self, texts):
        number, flat = self.ids.__getitem__, [0]
        for t in texts:
            if t:
                flat.extend(map(number, plain_words(t)))
                flat.append(0)
        n = len(self.ids.names)
        x = np.array(flat, np.int64)
        buckets = np.array(self.ids.buckets, np.int64)
        left = x[1:] * (2 * BUCKETS) + buckets[x[:-1]]
        right = x[:-1] * (2 * BUCKETS) + BUCKETS + buckets[x[1:]]
        self.codes += [left[x[1:] > 0], right[x[:-1] > 0]]
        self.pending += len(x)
        self.counts = np.pad(self.counts, (0, max(0, n - len(self.counts))))
        self.counts += np.bincount(x, minlength=n)
        if self.pending > 2_000_000:
            self._fold()
        if n > self.most:
            return self._rows()
        return {"word": [], "n": [], "at": [], "c": []}

    def _fold(self) -> None:
        if self.codes:
            keys, n = np.unique(np.concatenate(self.codes), return_counts=True)
            both = np.concatenate((self.cells[0], keys)), np.concatenate((self.cells[1], n))
            keys, inverse = np.unique(both[0], return_inverse=True)
            self.cells = keys, np.bincount(inverse, both[1]).astype(np.int64)
            self.codes, self.pending = [], 0

    def _rows(self) -> dict[str, list]:
        self._fold()
        keys, n = self.cells
        word, at = keys // (2 * BUCKETS), (keys % (2 * BUCKETS)).astype(np.int32)
        names = self.ids.names
        cut = np.searchsorted(word, np.arange(len(names) + 1))
        out: dict[str, list] = {"word": [], "n": [], "at": [], "c": []}
        total = np.bincount(at, n, 2 * BUCKETS)
        for i in range(1, len(names)):
            if names[i][-1] != "\x00":
                lo, hi = cut[i], cut[i + 1]
                for k, v in zip(out, (names[i], int(self.counts[i]), at[lo:hi], n[lo:hi])):
                    out[k].append(v)
        for k, v in zip(out, ("", int(self.counts[1:].sum()), np.arange(2 * BUCKETS, dtype=np.int32), total.astype(np.int64))):
            out[k].append(v)
        self.clear()
        return out

    def finish(self):
        yield self._rows()


def word_vectors(df: DataFrame, text: str) -> DataFrame:
    """Rows (word, n, ctx): occurrences, and the counts of left and right context buckets. The word '' has all words' totals."""
    parts = map_columns(df, {"t": text}, _Learner, "word string, n long, at array<int>, c array<long>")

    def run(batches):
        rows: dict[str, int] = {}
        ns, keys, sums = np.zeros(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        new: list[tuple[np.ndarray, np.ndarray]] = []

        def fold():
            both = [np.concatenate(x) for x in zip((keys, sums), *new)]
            cells, inverse = np.unique(both[0], return_inverse=True)
            new.clear()
            return cells, np.bincount(inverse, both[1], len(cells)).astype(np.int64)

        for batch in batches:
            at = np.array([rows.setdefault(w, len(rows)) for w in batch.column(0).to_pylist()], np.int64)
            ns = np.pad(ns, (0, len(rows) - len(ns)))
            np.add.at(ns, at, batch.column(1).to_numpy())
            cells = np.repeat(at, batch.column(2).value_lengths().to_numpy()) * (2 * BUCKETS) + batch.column(2).flatten().to_numpy()
            new.append((cells, batch.column(3).flatten().to_numpy()))
            if sum(len(x) for x, _ in new) > 2_000_000:
                keys, sums = fold()
        keys, sums = fold()
        words, size = list(rows), 2000
        cut = np.searchsorted(keys, np.arange(0, len(words) + size, size) * (2 * BUCKETS))
        for k in range(0, len(words), size):
            some = slice(cut[k // size], cut[k // size + 1])
            ctx = np.zeros(len(words[k : k + size]) * 2 * BUCKETS, np.int64)
            ctx[keys[some] - k * 2 * BUCKETS] = sums[some]
            yield pa.RecordBatch.from_arrays([pa.array(words[k : k + size], pa.string()), pa.array(ns[k : k + size]), pa.FixedSizeListArray.from_arrays(pa.array(ctx), 2 * BUCKETS).cast(pa.list_(pa.int64()))], ["word", "n", "ctx"])

    return parts.repartition("word").select("word", "n", "at", "c").mapInArrow(run, "word string, n long, ctx array<long>")


def _information(ctx: np.ndarray, n: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Mutual information of words (rows) with buckets, smoothed by ten expected neighbours."""
    return np.log((ctx + 10 * share + 1e-9) / ((n[:, None] + 10) * share + 1e-9))


def _contexts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(1).to_numpy().astype(float), batch.column(2).flatten().to_numpy().reshape(-1, 2 * BUCKETS)


def skip_gram_basis(words: DataFrame, totals: dict, least: float, size: int) -> np.ndarray:
    """The leading eigenvectors (256 x ``size``) of the lexicon's mutual information; each word weighs as the root of its occurrences."""
    share = np.array(totals["ctx"], float) / max(totals["n"], 1)

    def run(batches):
        gram = np.zeros((2 * BUCKETS, 2 * BUCKETS))
        for batch in batches:
            if batch.num_rows:
                n, ctx = _contexts(batch)
                rows = _information(ctx, n, share) * n[:, None] ** 0.25
                gram += rows.T @ rows
        if gram.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(gram.size, dtype=np.int32)), pa.array(gram.ravel())], ["cell", "v"])

    cells = words.filter((F.col("word") != "") & (F.col("n") >= least)).select("word", "n", "ctx").mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    gram = np.zeros(4 * BUCKETS * BUCKETS)
    gram[cells.column("cell").to_numpy()] = cells.column("v").to_numpy()
    return np.linalg.eigh(gram.reshape(2 * BUCKETS, 2 * BUCKETS))[1][:, -size:]


def skip_gram_vectors(words: DataFrame, totals: dict, basis: np.ndarray) -> DataFrame:
    """Rows (item, vec): the vector of each word."""
    share = np.array(totals["ctx"], float) / max(totals["n"], 1)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                n, ctx = _contexts(batch)
                vec = (_information(ctx, n, share) @ basis).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(vec.ravel()), basis.shape[1]).cast(pa.list_(pa.float32()))], ["item", "vec"])

    return words.filter(F.col("word") != "").select("word", "n", "ctx").mapInArrow(run, "item string, vec array<float>")


# --- lines --------------------------------------------------------------------------------------------------------------------------
_ROW = "kind string, region_id long, doc_id string, page int, node int, line int, a string, b string, cands array<string>, ns array<long>, lb int, rb int, lines int, prose boolean, at array<int>, tops array<string>, nums array<int>, styles array<boolean>, keys array<array<string>>"
_NAMES = [x.strip().split(" ")[0] for x in _ROW.split(",")]
_NO_WORD, _NO_TOPS = (None,) * 4, (None,) * 7


class _Reader:
    def __init__(self, lexicon: dict[str, int], demoted: dict[str, list[str]], rare: bool = False):
        self.lexicon, self.demoted, self.rare = lexicon, demoted, rare
        self.good = frozenset(lexicon) - frozenset(demoted)
        self.neighbours = lru_cache(1 << 17)(self._neighbours)

    def _neighbours(self, w: str) -> tuple[str, ...]:
        if w in self.demoted:
            return tuple(self.demoted[w])
        hits = glyph_neighbours(w, self.good, 2 if len(w) >= 6 else 1)
        if hits or "-" not in w:
            return tuple(hits)
        parts = w.split("-")  # a compound: its parts may be known by themselves
        fixed = [p if p in self.good else next(iter(glyph_neighbours(p, self.good)), None) for p in parts]
        return ("-".join(fixed),) if all(fixed) and fixed != parts else ()

    def item(self, left: str, right: str) -> str:
        """The word of two halves as it must read."""
        a, b = left.lower(), right.lower()
        joined, compound = a + b, f"{a}-{b}"
        get = self.lexicon.get
        if joined in self.good or compound in self.good:
            return joined if get(joined, 0) >= get(compound, 0) else compound
        for form in (joined, compound):
            if hits := self.neighbours(form):
                return max(hits, key=lambda h: (get(h, 0), h))
        return joined

    @staticmethod
    def whole_lines(lines: list[str]) -> list[str]:
        """The lines, with the second half of each parted word moved up to its first."""
        out, carry = [], ""
        for i, line in enumerate(lines):
            line = line[len(carry) :] if carry and line.lstrip().startswith(carry.strip()) else line
            carry = ""
            bare = line.rstrip()
            if bare and bare[-1] in _HYPHENS and i + 1 < len(lines) and (m := re.match(r"\s*" + _RIGHT.pattern, lines[i + 1])) and _LEFT.search(bare, 0, len(bare) - 1):
                carry = m[0]
                line = bare[:-1] + carry.strip()
            out.append(line)
        return out

    def suspects(self, words: list[str]) -> dict[str, tuple[str, ...]]:
        """Words outside the lexicon, with what they may be misreadings of; with nothing if that is sought among rare words."""
        out = {}
        for w in set(words) - self.good:
            if len(w) >= 3 and w.islower() and ((hits := self.neighbours(w) or _letters_for_digits(w)) or self.rare):
                out[w] = hits
        return out

    def __call__(self, regions, docs, pages, nodes, texts):
        rows: list[tuple] = []
        lexicon = self.lexicon
        for region, doc, page, node, text in zip(regions, docs, pages, nodes, texts):
            if not text or not (lines := [x for x in text.replace("\r", "").split("\n") if x and not x.isspace()]):
                continue
            here = (region, doc, page, node)
            n = len(lines)
            body = "\n".join(lines)
            words = plain_words(body)
            prose = len(words) > 4 and sum(map(_COMMON.__contains__, text.lower().split())) * 5 >= len(words)
            table = None
            tops = []
            for i in (0, 1, 2, n - 1) if n > 3 else range(n):
                num = page_number(lines[i])
                if num is None and i > 2:
                    continue  # the last line is of interest as a page number only
                bare = lines[i].strip()
                keys = header_keys(bare, page) if num is None else []
                if keys and n > 1 and " " not in bare:  # a cell of a table written cell under cell is no header
                    table = block_kind(lines, Counter()) == "table" if table is None else table
                    keys = [] if table else keys
                tops.append((i, bare, num and num[0], num and num[1], keys))
            rows.append(("R", *here, None, None, None, *_NO_WORD, n, prose, *zip(*tops)))
            last = n - 1
            while last > 0 and page_number(lines[last]):
                last -= 1
            if last < n - 1:
                body = "\n".join(lines[: last + 1])
            breaks = parted(body)
            if breaks:
                starts = np.cumsum([len(x) + 1 for x in lines])
                for at, left, right in breaks:
                    rows.append(("H", *here, int(np.searchsorted(starts, at, side="right")), left, self.item(left, right), *_NO_WORD, *_NO_TOPS))
            tail = lines[last].rstrip()
            if tail[-1] in _HYPHENS and (m := _LEFT.search(tail, max(0, len(tail) - 80), len(tail) - 1)):
                rows.append(("E", *here, last, m[0], None, *_NO_WORD, *_NO_TOPS))
            if not prose or not (suspects := self.suspects(words)):
                continue
            for i, line in enumerate(self.whole_lines(lines[: last + 1]) if breaks else lines[: last + 1]):
                if not any(map(line.__contains__, suspects)):
                    continue
                own = _tokens(line)
                if len(own) > 4 and sum(x.lower() in lexicon for x in own) * 3 < len(own):
                    continue  # no running text
                for k, w in enumerate(own):
                    if (hits := suspects.get(w)) is not None:
                        rows.append(("M" if hits else "U", *here, i, w, None, list(hits), [lexicon.get(h, 0) for h in hits],
                                     _bucket(own[k - 1].lower()) if k else None, _bucket(own[k + 1].lower()) if k + 1 < len(own) else None, *_NO_TOPS))
        return dict(zip(_NAMES, map(list, zip(*rows)))) if rows else {k: [] for k in _NAMES}


def _letters_for_digits(w: str) -> tuple[str, ...]:
    """A word with a digit or two between letters, which no word has, with the letters that they look like."""
    digits = sum(map(str.isdigit, w))
    if not 1 <= digits <= 2 or len(w) < 5 or digits * 3 > len(w):
        return ()
    v = w.translate(str.maketrans("015962", "olsgbz"))
    return (v,) if v.isalpha() and not re.search(r"[^aeiouy]{5}", v) else ()


def _demoted(lexicon: dict[str, int], ratio: float) -> dict[str, list[str]]:
    """Lexicon words that are misreadings of much more frequent ones."""
    out = {}
    for w, n in lexicon.items():
        if hits := [h for h in glyph_neighbours(w, lexicon) if lexicon[h] >= ratio * n]:
            out[w] = hits
    return out


class _Any:
    def __contains__(self, word: str) -> bool:
        return True


def rare_neighbours(words: DataFrame, least: float, ratio: float) -> DataFrame:
    """Rows (word, cands, ns): words outside the lexicon, and what they may be misreadings of outside it, fewest edits first."""

    def make():
        def run(names, ns):
            out = []
            for w, n in zip(names, ns):
                one = set(glyph_neighbours(w, _Any()))
                two = {x for v in one for x in glyph_neighbours(v, _Any())} - one - {w} if len(w) >= 6 else ()
                out += [(w, n, v, 1) for v in one] + [(w, n, v, 2) for v in two]
            return dict(zip(("word", "own", "item", "edits"), map(list, zip(*out)))) if out else {k: [] for k in ("word", "own", "item", "edits")}

        return run

    outside = words.filter((F.col("word") != "") & (F.col("n") < least))
    variants = map_columns(outside.filter((F.length("word") >= 3) & (F.col("n") * ratio < least)), {"word": "word", "n": "n"}, make, "word string, own long, item string, edits int")
    known = outside.filter(F.col("n") >= ratio).select(F.col("word").alias("item"), "n")
    pairs = variants.join(known, "item").filter(F.col("n") >= ratio * F.col("own"))
    pairs = pairs.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("edits", "item", "n"))).alias("x"))
    pairs = pairs.select("word", F.filter("x", lambda y: y["edits"] == F.col("x")[0]["edits"]).alias("x"))
    return pairs.select("word", F.col("x.item").alias("cands"), F.col("x.n").alias("ns"))


def scan_rows(df: DataFrame, region_id: str, doc_id: str, page: str, node: str, text: str, lexicon_share: float, ratio: float) -> tuple[DataFrame, DataFrame, dict]:
    """The rows of pass 2 and the words of pass 1, both written, and the bucket totals."""
    words = written(word_vectors(df.select(F.col(text).alias("t")).distinct(), "t"), "words")  # copies and regions delivered again count once
    totals = words.filter("word = ''").first()
    if totals is None:
        totals = {"n": 0, "ctx": [0] * (2 * BUCKETS)}
    least = max(2.0, lexicon_share * totals["n"])
    lexicon = {r.word: r.n for r in words.filter((F.col("word") != "") & (F.col("n") >= least)).select("word", "n").toLocalIterator()}
    demoted = _demoted(lexicon, ratio)
    rare = least > ratio  # else no word outside the lexicon is frequent enough to be the right one
    shared = df.sparkSession.sparkContext.broadcast((lexicon, demoted, rare))
    ids = {"r": F.col(region_id).cast("long"), "d": F.col(doc_id).cast("string"), "p": F.coalesce(F.col(page).cast("int"), F.lit(-1)), "n": F.coalesce(F.col(node).cast("int"), F.lit(-1)), "t": F.col(text)}
    rows = map_columns(df, ids, lambda: _Reader(*shared.value), _ROW)
    rows = written(rows, "lines", "kind")
    if rare:
        pairs = written(rare_neighbours(words, least, ratio), "pairs")
        found = rows.filter("kind = 'U'").drop("cands", "ns").join(pairs, F.col("a") == F.col("word")).drop("word")
        rows = rows.unionByName(found.withColumn("kind", F.lit("M")))
    return rows, words, totals


# --- verdicts -----------------------------------------------------------------------------------------------------------------------
def _top_lines(rows: DataFrame, top: int) -> DataFrame:
    """Lines with ``above``, the page's lines before them, and ``bottom``, whether they end the page. Regions delivered again share a place.

    One shuffle and sort by page: sums up to a place and over the page give what stands before and after it. Regions stay one row each until
    those far from either end of the page are left out."""
    place = ["doc_id", "page", "node"]
    regions = rows.filter("kind = 'R'").select("region_id", *place, "lines", "prose", "at", "tops", "nums", "styles", "keys").repartition("doc_id", "page")
    copies = Window.partitionBy(*place).orderBy("region_id")
    all_copies = copies.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Tables and the like stand before or after the running text of a page; its first and last lines are those without them, too.
    regions = regions.withColumns({"most": F.max("lines").over(all_copies), "flows": F.max(F.col("prose") | (F.col("lines") <= top)).over(all_copies), "copy": F.row_number().over(copies)})
    once = F.when(F.col("copy") == 1, F.col("most")).otherwise(0)
    regions = regions.withColumns({"once": once, "flowing": F.when(F.col("flows"), once).otherwise(0)})
    so_far = Window.partitionBy("doc_id", "page").orderBy("node")  # with all copies of a place
    page = so_far.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    regions = regions.withColumns({f"{c}_{k}": F.sum(c).over(w) for c in ("once", "flowing") for k, w in (("so_far", so_far), ("page", page))})
    before = F.least(F.col("once_so_far") - F.col("most"), F.when(F.col("flows"), F.col("flowing_so_far") - F.col("most")))
    after = F.least(F.col("once_page") - F.col("once_so_far"), F.when(F.col("flows"), F.col("flowing_page") - F.col("flowing_so_far")))
    regions = regions.withColumns({"before": before, "is_last": after == 0}).filter((F.col("before") < top) | F.col("is_last"))
    lines = regions.select("region_id", "doc_id", "page", "lines", "prose", "before", "is_last", F.explode(F.arrays_zip("at", "tops", "nums", "styles", "keys")).alias("x"))
    lines = lines.select("region_id", "doc_id", "page", "lines", "prose", "before", "is_last", F.col("x.at").alias("line"), F.col("x.tops").alias("a"), F.col("x.nums").alias("num"), F.col("x.styles").alias("styled"), F.col("x.keys").alias("keys"))
    return lines.withColumn("above", F.col("before") + F.col("line")).withColumn("bottom", F.col("is_last") & (F.col("line") == F.col("lines") - 1)).drop("before", "is_last")


def _furniture(rows: DataFrame, top: int = 3) -> DataFrame:
    """Rows (region_id, line, noise_kind, item) of page numbers and running headers."""
    lines = _top_lines(rows, top)
    is_number = F.col("num").isNotNull() & ((F.col("above") < top) | F.col("bottom"))
    is_head = (F.size("keys") > 0) & (F.col("above") < top)
    lines = written(lines.filter(is_number | is_head), "edges")
    numbers = lines.filter(is_number).withColumn("apart", F.col("num") - F.col("page"))
    several = F.min("page") < F.max("page")  # more than one page
    agree = numbers.groupBy("doc_id", "apart").agg(several.alias("agrees"))
    numbers = numbers.join(agree, [F.equal_null(numbers["doc_id"], agree["doc_id"]), numbers["apart"] == agree["apart"]]).drop(agree["doc_id"], agree["apart"])
    bare_ok = F.col("agrees") | F.col("prose") | ((F.col("lines") == 1) & (F.col("apart") == 0))
    numbers = numbers.filter(F.col("styled") | bare_ok)
    heads = lines.filter(is_head).select("region_id", "line", "a", "doc_id", "page", F.explode("keys").alias("skel"))
    again = heads.groupBy("doc_id", "skel").agg(several.alias("returns")).filter("returns")
    heads = heads.join(again, [F.equal_null(heads["doc_id"], again["doc_id"]), heads["skel"] == again["skel"]], "left_semi")
    pick = lambda x, kind: x.select("region_id", "line", F.lit(kind).alias("noise_kind"), F.col("a").alias("item"))
    return pick(numbers, "page_number").unionByName(pick(heads, "running_header"))


def _carried_on(rows: DataFrame, furniture: DataFrame) -> DataFrame:
    """Rows (region_id, a, b): halves at the end of a region, and the first word of the document's next text."""
    place = ["doc_id", "page", "node"]
    gone = furniture.groupBy("region_id").agg(F.collect_set("line").alias("gone"))
    tops = rows.filter("kind = 'R'").select("region_id", *place, F.arrays_zip("at", "tops").alias("x")).join(gone, "region_id", "left")
    body = F.filter("x", lambda x: (x["at"] < 3) & ~F.coalesce(F.array_contains("gone", x["at"]), F.lit(False)))
    first = tops.select(*place, F.get(body, F.lit(0))["tops"].alias("a")).filter("a IS NOT NULL")
    first = first.withColumn("b", F.regexp_extract("a", r"(?U)^\s*((?:\p{L}[\p{L}\p{N}]*)(?:-[\p{L}\p{N}]+)*)", 1))
    starts = first.filter(F.col("b").rlike(r"(?U)^\p{Ll}")).groupBy(*place).agg(F.min("b").alias("b"))
    ends = rows.filter("kind = 'E'").select("region_id", *place, "a", F.lit(0).alias("o"), F.lit(None).cast("string").alias("b"))
    # The nearest later text, on the page or behind it, that begins inside a sentence: one sort by document, from last to first, ends before starts.
    both = ends.unionByName(starts.select(F.lit(None).cast("long").alias("region_id"), *place, F.lit(None).cast("string").alias("a"), F.lit(1).alias("o"), "b"))
    back = Window.partitionBy("doc_id").orderBy(F.desc("page"), F.desc("node"), "o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("b", F.last("b", ignorenulls=True).over(back)).filter("o = 0 AND b IS NOT NULL").select("region_id", "a", "b")


def _best_neighbours(rows: DataFrame, words: DataFrame, totals: dict, ratio: float, lexicon_share: float, size: int = 64) -> DataFrame:
    """Rows (region_id, line, word, item): each misread word with the neighbour that fits best."""
    place = ["region_id", "line", "word", "lb", "rb"]
    found = rows.filter("kind = 'M'").select("region_id", "line", F.col("a").alias("word"), "lb", "rb", F.arrays_zip("cands", "ns").alias("z"))
    found = found.join(words.select("word", F.col("n").alias("own")), "word", "left")
    frequent = F.filter("z", lambda x: (x["ns"] == 0) | (x["ns"] >= ratio * F.coalesce(F.col("own"), F.lit(1))))
    found = written(found.select(*place, frequent.alias("z")).filter(F.size("z") > 0), "misread")
    one = found.filter(F.size("z") == 1).select("region_id", "line", "word", F.col("z")[0]["cands"].alias("item"))
    several = found.filter(F.size("z") > 1).select(*place, F.explode("z").alias("x")).select(*place, F.col("x.cands").alias("item"), F.col("x.ns").alias("n"))
    wanted = written(several.select(F.col("item").alias("word")).distinct(), "wanted")  # few of the words: the others need no vectors
    if wanted.isEmpty():
        return one
    basis = skip_gram_basis(words, totals, max(2.0, lexicon_share * totals["n"]), size)
    several = several.join(skip_gram_vectors(words.join(wanted, "word", "left_semi"), totals, basis), "item", "left")
    shared = rows.sparkSession.sparkContext.broadcast(basis.astype(np.float32))


    def run(batches):
        basis = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lefts, rights, ns = (batch.column(k).fill_null(-1).to_numpy(zero_copy_only=False) for k in (3, 4, 6))
            vec = batch.column(7)
            known = vec.is_valid().to_numpy(zero_copy_only=False)
            fit = np.zeros(batch.num_rows)
            if known.any():
                own = vec.flatten().to_numpy().reshape(-1, basis.shape[1])
                for at, side in ((lefts[known], 0), (rights[known], BUCKETS)):
                    fit[known] += np.where(at >= 0, np.einsum("ij,ij->i", own, basis[side + np.maximum(at, 0)]), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(fit + np.log(ns + 1.0))], [*place, "item", "n", "score"])

    scored = several.select(*place, "item", "n", "vec").mapInArrow(run, "region_id long, line int, word string, lb int, rb int, item string, n long, score double")
    best = F.max_by("item", F.struct("score", "n", F.hash("item")))
    return one.unionByName(scored.groupBy(*place).agg(best.alias("item")).select("region_id", "line", "word", "item"))


def _halves(rows: DataFrame, furniture: DataFrame, words: DataFrame) -> DataFrame:
    """Rows (region_id, item, a, next_doc, next_page, next_node): words parted at a region's end, as they must read, and where they go on."""
    known = words.filter(F.col("word") != "").select("word", "n")
    joined, compound = F.lower(F.concat("a", "b")), F.lower(F.concat_ws("-", "a", "b"))
    c = _carried_on(rows, furniture).withColumns({"j": joined, "c": compound})
    c = c.join(known.select(F.col("word").alias("j"), F.col("n").alias("jn")), "j", "left").join(known.select(F.col("word").alias("c"), F.col("n").alias("cn")), "c", "left")
    return c.select("region_id", "a", "b", F.when(F.coalesce("cn", F.lit(0)) > F.coalesce("jn", F.lit(0)), F.col("c")).otherwise(F.col("j")).alias("item"))


_ENDED = re.compile(r"""[.!?:;]["'”’)\]]*\Z""")


def _repair(text: str, furniture: list[int], fixes: dict[str, str], half: tuple[str, str] | None, item) -> str:
    """One region's text: furniture lines left out, parted and misread words put right, lines joined to a paragraph."""
    lines = [x for x in text.replace("\r", "").split("\n") if x and not x.isspace()]
    body = "\n".join(x.strip() for i, x in enumerate(lines) if i not in furniture)
    for at, left, right in reversed(parted(body)):
        tail = _BREAK.match(body, at)
        word = item(left, right)
        word = word[0].upper() + word[1:] if left[0].isupper() else word
        body = body[: at - len(left)] + word + body[tail.end() + len(right) :]
    if half and body.rstrip()[-1:] in _HYPHENS:
        body = body.rstrip()
        body = body[: len(body) - 1 - len(half[0])] + (half[1] if half[0][0].islower() else half[1].capitalize())
    if fixes:
        body = _TOKEN.sub(lambda m: fixes.get(m[0], m[0]), body)
    return " ".join(body.split())


def repaired_paragraphs(df: DataFrame, region_id: str = "region_id", doc_id: str = "doc_id", page: str = "page_no", node: str = "node_id", text: str = "text", created: str = "created_at", lexicon_share: float = 1e-6, ratio: float = 4.0) -> DataFrame:
    """Rows (doc_id, page, node, text): each paragraph of running text, whole and readable, at the place where it begins.

    A region that begins in the middle of a sentence belongs to the paragraph of the text before it; such chains are put together as
    components, so no document has to fit one task. Regions delivered again count once (the latest). Tables and the like keep their lines."""
    rows, words, totals = scan_rows(df, region_id, doc_id, page, node, text, lexicon_share, ratio)
    furniture = written(_furniture(rows), "furniture")
    halves = written(_halves(rows, furniture, words), "halves")
    fixes = _best_neighbours(rows, words, totals, ratio, lexicon_share).groupBy("region_id").agg(F.collect_set(F.concat_ws("\x01", "word", "item")).alias("fixes"))
    gone = furniture.groupBy("region_id").agg(F.collect_set("line").alias("gone"))
    ends = halves.groupBy("region_id").agg(F.min(F.concat_ws("\x01", "a", "item")).alias("half"))
    joins = rows.filter("kind = 'H'").groupBy("region_id").agg(F.collect_set(F.concat_ws("\x01", "a", "b")).alias("joins"))
    flows = rows.filter("kind = 'R'").select("region_id", "prose")
    src = df.select(F.col(region_id).cast("long").alias("region_id"), F.col(doc_id).cast("string").alias("doc_id"), F.coalesce(F.col(page).cast("int"), F.lit(-1)).alias("page"), F.coalesce(F.col(node).cast("int"), F.lit(-1)).alias("node"),
                    F.struct(F.col(created).cast("timestamp").isNotNull(), F.col(created).cast("timestamp"), F.col(region_id).cast("long")).alias("_o"), F.col(text).alias("text"))
    newest = src.groupBy("doc_id", "page", "node").agg(F.max_by("region_id", "_o").alias("region_id")).select("region_id")
    src = src.drop("_o").join(newest, "region_id", "left_semi").join(flows, "region_id")
    for extra in (gone, fixes, ends, joins):
        src = src.join(extra, "region_id", "left")

    def make():
        def run(docs, pages, nodes, texts, proses, gones, fixed, ended, joined):
            out = []
            for d, p, n, t, prose, g, f, e, j in zip(docs, pages, nodes, texts, proses, gones, fixed, ended, joined):
                if not prose:
                    kept = [x for i, x in enumerate(y for y in t.replace("\r", "").split("\n") if y and not y.isspace()) if i not in (g or ())]
                    out.append((d, p, n, "\n".join(kept), False, False))
                    continue
                known = dict(x.split("\x01") for x in j or ())
                half = tuple(e.split("\x01")) if e else None
                body = _repair(t, g or [], dict(x.split("\x01") for x in f or ()), half, lambda a, b: known.get(a, (a + b).lower()))
                out.append((d, p, n, body, body[:1].islower(), not _ENDED.search(body)))
            return dict(zip(("doc_id", "page", "node", "text", "inside", "open"), map(list, zip(*out)))) if out else dict.fromkeys(("doc_id", "page", "node", "text", "inside", "open"), [])

        return run

    columns = {c: F.col(c) for c in ("doc_id", "page", "node", "text", "prose", "gone", "fixes", "half", "joins")}
    done = map_columns(src, columns, make, "doc_id string, page int, node int, text string, inside boolean, open boolean").filter("text <> ''")
    done = written(done.withColumn("id", F.monotonically_increasing_id()), "repaired")
    before = done.filter("open").select(F.col("doc_id").alias("d"), F.col("page").alias("p"), F.col("node").alias("n"), F.col("id").alias("a"))
    later = done.filter("inside").select("doc_id", "page", "node", F.col("id").alias("b"))
    same = later.join(before, F.equal_null("doc_id", "d") & (F.col("p") == F.col("page")) & (F.col("n") < F.col("node"))).groupBy("b").agg(F.max_by("a", "n").alias("a"))
    ended_page = before.groupBy("d", "p").agg(F.max_by("a", "n").alias("a"))
    over = later.join(same.select("b"), "b", "left_anti").join(ended_page, F.equal_null("doc_id", "d") & (F.col("p") == F.col("page") - 1)).select("b", "a")
    links = same.select("a", "b").unionByName(over.select("a", "b"))
    place = done.select("id", "doc_id").withColumn("doc_id", F.coalesce("doc_id", F.lit("")))
    edges = links.join(place.withColumnRenamed("id", "b"), "b").select("doc_id", "a", "b")
    labels = components(place, edges).select("id", "label")
    whole = done.join(labels, "id").withColumn("starts", F.struct("page", "node"))
    drop_first = lambda x, k: F.when((k > 0) & F.coalesce(x["cut"], F.lit(False)), F.regexp_replace(x["text"], r"^\S+\s*", "")).otherwise(x["text"])
    cut = halves.select("region_id").join(df.select(F.col(region_id).cast("long").alias("region_id"), F.col(doc_id).cast("string").alias("doc_id"), F.coalesce(F.col(page).cast("int"), F.lit(-1)).alias("page"), F.coalesce(F.col(node).cast("int"), F.lit(-1)).alias("node")), "region_id")
    cut = cut.join(done.select(F.col("doc_id").alias("d"), F.col("page").alias("p"), F.col("node").alias("n"), "id"), F.equal_null("doc_id", "d") & (F.col("page") == F.col("p")) & (F.col("node") == F.col("n")))
    cut = cut.select(F.col("id").alias("a")).join(links, "a").select(F.col("b").alias("id"), F.lit(True).alias("cut")).distinct()
    whole = whole.join(cut, "id", "left")
    parts = F.array_sort(F.collect_list(F.struct("page", "node", "text", "cut")))
    out = whole.groupBy("doc_id", "label").agg(F.min("starts").alias("s"), parts.alias("x"))
    return out.select("doc_id", "s.page", "s.node", F.array_join(F.transform("x", drop_first), " ").alias("text"))


def scan_noise(df: DataFrame, region_id: str = "region_id", doc_id: str = "doc_id", page: str = "page_no", node: str = "node_id", text: str = "text", lexicon_share: float = 1e-6, ratio: float = 4.0) -> DataFrame:
    """Rows (region_id, noise_kind, item), each once: ``hyphen_split``, ``misread_char``, ``running_header`` and ``page_number``."""
    rows, words, totals = scan_rows(df, region_id, doc_id, page, node, text, lexicon_share, ratio)
    furniture = written(_furniture(rows), "furniture")
    in_line = rows.filter("kind = 'H'").join(furniture.select("region_id", "line"), ["region_id", "line"], "left_anti").select("region_id", F.col("b").alias("item"))
    carried = _halves(rows, furniture, words).select("region_id", "item")
    misread = _best_neighbours(rows, words, totals, ratio, lexicon_share).join(furniture.select("region_id", "line"), ["region_id", "line"], "left_anti").select("region_id", "item")
    out = in_line.withColumn("noise_kind", F.lit("hyphen_split")).unionByName(carried.withColumn("noise_kind", F.lit("hyphen_split"))).unionByName(misread.withColumn("noise_kind", F.lit("misread_char")))
    return out.select("region_id", "noise_kind", "item").unionByName(furniture.select("region_id", "noise_kind", "item")).distinct()
