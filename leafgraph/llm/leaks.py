"""Evaluation passages in training text (problem 7).

The items' passages, normalised to words and without standing notices, go into one generalised suffix automaton over words. Documents are
streamed through it: at every word the automaton's state holds the longest piece of any passage that ends there. Where that is at least
``least`` words long, the state reached over suffix links down to exactly ``least`` words names every item that has those words in a row.

Items are a query set: they are taken in blocks of at most ``block_words`` words, so the automaton that each task builds is bounded
whatever their number; every document meets every block. Documents are read in one narrow pass a block, without a shuffle.

Words: compatibility forms (ligatures, wide letters) unfolded, case folded, soft hyphens removed, a hyphen joins its halves whether a line
ends there or not, all else that is no letter or digit parts words.

Defined results for odd input: null or empty texts and passages of fewer than ``least`` words match nothing; a passage that consists of
notices only matches nothing; repeated items or documents give a row for each id, each pair once; no items, or no documents, no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.batches import map_columns
from leafgraph.sources.tables import written

_SOFT = re.compile("[\u00ad\u200b\u200c\u200d\u2060\ufeff]")
_JOIN = re.compile(r"(?<=[^\W\d_])[-\u2010\u2011\u00ac]\s*(?=[^\W\d_])")
_WORDS = re.compile(r"[^\W_]+")
_SENTENCE = regex.compile(r"(?V1)(?<=[.!?…])[\"'”’»)\]]*\s+(?=[\"'“‘«(\[¿¡]*(?:\p{Lu}|\p{Lt}|\p{Lo}|\p{N}))|(?<=[。！？])\s*")


def normal_words(text: str | None) -> list[str]:
    """The words of a text, whatever its case, punctuation, spacing, line-break hyphens and forms of letters."""
    if not text:
        return []
    if not text.isascii():
        text = _SOFT.sub(lambda m: "-" if m[0] == "\u00ad" and _breaks(text, m.end()) else "", text)
        text = unicodedata.normalize("NFKC", text).casefold()
    else:
        text = text.lower()
    if "-" in text or not text.isascii():
        text = _JOIN.sub("", text)
    return _WORDS.findall(text)


def _breaks(text: str, at: int) -> bool:
    """Whether only white space with a line end stands between here and the next word."""
    return bool(re.match(r"[^\S\n]*\n", text[at : at + 8]))


class Automaton:
    """Generalised suffix automaton over words; ``items[v]`` are the numbers of the sequences in which the pieces of state v stand."""

    def __init__(self, sequences: Iterable[tuple[int, list[str]]]):
        self.next: list[dict[str, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        own: list[set[int]] = [set()]
        for number, words in sequences:
            last = 0
            for w in words:
                last = self._extend(last, w, own)
                own[last].add(number)
        for v in sorted(range(1, len(own)), key=self.length.__getitem__, reverse=True):
            own[self.link[v]] |= own[v] if self.link[v] > 0 else set()
        self.items = own

    def _extend(self, last: int, w: str, own: list[set[int]]) -> int:
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(w)
        if q is not None:  # the piece is known already from another sequence
            return q if length[q] == length[last] + 1 else self._split(last, w, q, own)
        cur = self._state(length[last] + 1, {}, own)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p < 0:
            link[cur] = 0
        else:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q, own)
        return cur

    def _state(self, length: int, transitions: dict[str, int], own: list[set[int]]) -> int:
        self.next.append(transitions)
        self.link.append(0)
        self.length.append(length)
        own.append(set())
        return len(self.length) - 1

    def _split(self, p: int, w: str, q: int, own: list[set[int]]) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), own)
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def matches(self, words: list[str]) -> Iterable[tuple[int, int, int]]:
        """End position, state and length of the longest piece that ends at each word."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        for i, w in enumerate(words):
            to = nxt[state].get(w)
            if to is None:
                while state > 0 and to is None:
                    state = link[state]
                    to = nxt[state].get(w)
                if to is None:
                    state = size = 0
                    continue
                size = length[state]
            state = to
            size += 1
            yield i, state, size

    def at_length(self, state: int, least: int) -> int:
        """The state of the last ``least`` words of a piece of at least that length."""
        while self.length[self.link[state]] >= least:
            state = self.link[state]
        return state


def standing_notices(passages: Iterable[list[list[str]]], in_items: int = 3) -> set[tuple[str, ...]]:
    """Sentences (as words) that stand in at least so many items; pieces of under four words are no sentences."""
    seen = Counter(s for sentences in passages for s in {tuple(x) for x in sentences if len(x) >= 4})
    return {s for s, n in seen.items() if n >= in_items}


def segments(sentences: list[list[str]], notices: set[tuple[str, ...]]) -> list[list[str]]:
    """Runs of words between the notices of a passage."""
    runs: list[list[str]] = [[]]
    for s in sentences:
        if tuple(s) in notices:
            runs.append([])
        else:
            runs[-1].extend(s)
    return [r for r in runs if r]


def item_blocks(rows: Iterable[tuple[int, str | None]], block_words: int, in_items: int = 3) -> list[list[tuple[int, list[list[str]]]]]:
    """Items with their segments, in blocks of bounded words."""
    split = [(i, [w for s in _SENTENCE.split(p or "") if (w := normal_words(s))]) for i, p in rows]
    notices = standing_notices((s for _, s in split), in_items)
    blocks: list[list[tuple[int, list[list[str]]]]] = [[]]
    size = 0
    for i, sentences in split:
        runs = segments(sentences, notices)
        n = sum(map(len, runs))
        if size and size + n > block_words:
            blocks.append([])
            size = 0
        blocks[-1].append((i, runs))
        size += n
    return [b for b in blocks if b]


def _scanner(block: list[tuple[int, list[list[str]]]], least: int):
    automaton = Automaton((i, run) for i, runs in block for run in runs if len(run) >= least)
    known = frozenset(w for _, runs in block for run in runs for w in run)

    def scan(text: str | None) -> dict[int, list[int]]:
        """Per item: longest run of words, and words of the document that lie in runs of at least ``least``."""
        words = normal_words(text)
        if len(words) < least or sum(map(known.__contains__, words)) < least:
            return {}
        hits: dict[int, list[int]] = {}
        for end, state, size in automaton.matches(words):
            if size >= least:
                for item in automaton.items[automaton.at_length(state, least)]:
                    h = hits.get(item)
                    if h is None:
                        hits[item] = [least, least, end]
                    else:
                        run = h[3] + 1 if len(h) > 3 and h[2] == end - 1 else least + 1 if h[2] == end - 1 else least
                        h[1] += min(end - h[2], least)
                        h[0] = max(h[0], run)
                        hits[item] = [h[0], h[1], end, run]
        return hits

    return scan


def leaked_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage", least: int = 12, block_words: int = 200_000) -> DataFrame:
    """Rows (doc_id, item_id, longest_run, words_covered): documents that hold at least ``least`` words in a row of an item's passage.

    ``words_covered`` counts the document's words inside such runs, by which spans over a length or coverage limit can be removed."""
    rows = [tuple(r) for r in items.select(F.col(item_id).cast("long"), F.col(passage).cast("string")).toLocalIterator()]
    out = None
    for block in item_blocks(rows, block_words):

        def make(block=block):
            scan = _scanner(block, least)

            def run(ids, texts):
                got = [(i, item, h[0], h[1]) for i, t in zip(ids, texts) for item, h in scan(t).items()]
                return {k: list(v) for k, v in zip(("doc_id", "item_id", "longest_run", "words_covered"), zip(*got))} if got else dict.fromkeys(("doc_id", "item_id", "longest_run", "words_covered"), [])

            return run

        part = map_columns(docs, {"d": F.col(doc_id).cast("long"), "t": text}, make, "doc_id long, item_id long, longest_run int, words_covered int")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, longest_run int, words_covered int")
    return out


def _covered(words: list[str], automaton: Automaton, least: int) -> list[int]:
    """Where runs of at least ``least`` words of an item begin and end, as from, to, from, to, ..., joined where they touch."""
    spans: list[int] = []
    for end, _, size in automaton.matches(words):
        if size >= least:
            start = end - size + 1
            while spans and spans[-1] >= start:  # it reaches into the last span
                start = min(start, spans[-2])
                del spans[-2:]
            spans += (start, end + 1)
    return spans


def _merged(spans: list[int]) -> list[int]:
    out: list[int] = []
    for lo, hi in sorted(zip(spans[::2], spans[1::2])):
        if out and lo <= out[-1]:
            out[-1] = max(out[-1], hi)
        else:
            out += (lo, hi)
    return out


def _without(text: str, spans: list[int]) -> str:
    """The text without the words of the spans."""
    places = word_places(text)
    if len(places) != len(normal_words(text)):  # forms of letters that unfold into several words; the words themselves are kept then
        words = normal_words(text)
        return " ".join(w for lo, hi in zip([0, *spans[1::2]], [*spans[::2], len(words)]) for w in words[lo:hi])
    out, at = [], 0
    for lo, hi in zip(spans[::2], spans[1::2]):
        out.append(text[at : places[lo][0]])
        at = places[hi - 1][1]
    return "".join((*out, text[at:]))


_SPANS = "doc_id long, text string, spans array<int>"


def leaked_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage", least: int = 12, block_words: int = 200_000) -> DataFrame:
    """Rows (doc_id, text, spans): every document with the word positions that leaked, empty for most.

    Blocks of items are applied one after another, each in a pass whose result is written, so a task holds one block's automaton at a time;
    with one block, as here, it is a single narrow pass."""
    rows = [tuple(r) for r in items.select(F.col(item_id).cast("long"), F.col(passage).cast("string")).toLocalIterator()]
    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.array().cast("array<int>").alias("spans"))
    for k, block in enumerate(item_blocks(rows, block_words)):

        def make(block=block):
            automaton = Automaton((i, run) for i, runs in block for run in runs if len(run) >= least)
            known = frozenset(w for _, runs in block for run in runs for w in run)

            def run(ids, texts, before):
                spans = []
                for t, b in zip(texts, before):
                    words = normal_words(t)
                    found = _covered(words, automaton, least) if len(words) >= least and sum(map(known.__contains__, words)) >= least else []
                    spans.append(_merged(b + found) if b and found else b or found)
                return {"doc_id": ids, "text": texts, "spans": spans}

            return run

        out = map_columns(written(out, "spans") if k else out, {"doc_id": "doc_id", "text": "text", "spans": "spans"}, make, _SPANS)
    return out


def _cleaned(spans: DataFrame, most_covered: float) -> DataFrame:
    def make():
        def run(ids, texts, spans):
            share = [sum(s[1::2]) - sum(s[::2]) if s else 0 for s in spans]
            share = [n / len(normal_words(t)) if n else 0.0 for n, t in zip(share, texts)]
            kept = [x < most_covered for x in share]
            clean = [(_without(t, s) if s else t) if k else None for t, s, k in zip(texts, spans, kept)]
            return {"doc_id": ids, "text": clean, "spans_removed": [len(s) // 2 for s in spans], "share_covered": share, "kept": kept}

        return run

    return map_columns(spans, {"doc_id": "doc_id", "text": "text", "spans": "spans"}, make, "doc_id long, text string, spans_removed int, share_covered double, kept boolean")


def without_leaks(docs: DataFrame, items: DataFrame, most_covered: float = 0.8, **options) -> DataFrame:
    """Rows (doc_id, text, spans_removed) without the leaked spans; documents covered to ``most_covered`` or more are left out wholly."""
    return _cleaned(leaked_spans(docs, items, **options), most_covered).filter("kept").select("doc_id", "text", "spans_removed")


def leak_report(docs: DataFrame, items: DataFrame, most_covered: float = 0.8, **options) -> DataFrame:
    """Rows (doc_id, spans_removed, share_covered, kept) of the documents that ``without_leaks`` changes or leaves out."""
    return _cleaned(leaked_spans(docs, items, **options), most_covered).filter("spans_removed > 0").drop("text")


_PLACE = re.compile(r"[^\W_]+(?:[\u00ad\u200b-\u200d\u2060\ufeff]+\s*[^\W_]+|(?<=[^\W\d_])[-\u2010\u2011\u00ac]\s*(?=[^\W\d_])[^\W_]+)*")


def word_places(text: str) -> list[tuple[int, int]]:
    """Where the words that normal_words() gives stand in the text."""
    return [m.span() for m in _PLACE.finditer(text)]
