"""Text quality statistics, and prose told from lists, tables and junk (problem 3).

A text is taken block by block (blank lines part blocks), a block line by line:

* delimiters: tabs, pipes and wide gaps split a line into cells; lines with the same number of cells below one another are aligned. Gaps of
  two blanks count only where they stand above one another, column on column (``gap_columns``), as they do in tables and not in spaced prose;
  the share of aligned lines is the block's ``alignment``. A column written cell under cell shows as values on most lines, or as
  autocorrelation of the lines' kinds and lengths at the row's length (``row_period``, ``length_period``);
* markers and indentation: the share of lines that begin with a list marker; hanging indents, where each item's first line stands out and the
  rest goes on deeper (``hanging_items``), and levels that return with a period (``indent_period``);
* ratios: words, mean word length, symbols, lines closed by punctuation, words among the common function words of four languages, words
  without a vowel, words repeated on and on.

From these a block is ``table``, ``list``, ``junk`` or ``prose``. A document's kind is that of the greater part of its visible
characters: prose if prose has at least half, else the kind that has most. Sums over blocks need no order, so a document of any number
of pages is aggregated with map-side combination and no task ever holds it whole.

Defined results for odd input: a region delivered again replaces the earlier one (same document, page and node; latest ``created_at``,
then highest region id); null or blank texts count nothing, and a document without any text has zero counts, kind null and no row in
``found``; null page or node numbers group as values of their own; a null document id is a group like any other.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.batches import map_columns
from leafgraph.llm.words import FUNCTION_WORDS, WORD

KINDS = ("prose", "list", "table", "junk")
_COMMON = frozenset(w for words in FUNCTION_WORDS.values() for w in words)
_VOWEL = re.compile(r"[aeiouyàâäáéèêëíîïóôöúùûüœæ]", re.I)
_CELLS = re.compile(r"\t+|\s*\|\s*|\s{3,}")
_NARROW = re.compile(r"\t+|\s*\|\s*|\s{2,}")
_GAP = re.compile(r"(?<=\S) {2,}(?=\S)")
_VALUE = re.compile(r"[-(+]?[$€£¥]?\s?\d[\d.,:/]*\s?%?\)?|[-–—]|n/?a|\d+\s?[a-zA-Z]{1,3}", re.I)
_MARKER = re.compile(r"\s*(?:[-*•·–‣◦o+>]|\(?(?:\d{1,3}|[a-zA-Z]|[ivxlc]{1,5})[.):])\s+(?=\S)")
_CLOSED = re.compile(r"""[.!?;:]["'”’)\]]*\s*$""")
_SENTENCE_END = re.compile(r"""[a-zà-ÿ\d)"'][.!?]["'”’)\]]*(?=\s|$)""")
_RUN = re.compile(r"([^\w\s]|_|x)\1{5,}")
_SYMBOL = re.compile(r"[^\w\s]|_")
_VALUES = re.compile(r"(?:[-–—.$€£%()\d,/]+\s*)+")
_TYPOGRAPHIC = frozenset("•·–—‐¬\xad’‘“”„«»…¿¡€£§°")  # fixed values: signs that print has
_DENSE = re.compile(r"[A-Za-z0-9+/=_-]{16,}")


def _is_junk_line(bare: str, words: list[str], known: int) -> bool:
    """Filler, encoded bytes, broken encodings, one word over and over, or words that can't be pronounced. ``known``: function words in it."""
    if _RUN.search(bare) and len(_RUN.sub("", bare)) * 2 < len(bare):
        return True
    ink = len("".join(bare.split()))
    if not bare.isascii() and sum(ch > "\x7f" and not (ch.isalnum() or ch in _TYPOGRAPHIC) for ch in bare) * 8 > ink:
        return True
    if ink >= 8 and bare[0] != "|" and sum(map(len, words)) * 2 < ink and not _VALUES.fullmatch(bare):
        return True
    n = len(words)
    if n >= 3 and words[0] == words[1] and len(set(words)) == 1:
        return True
    if known * 5 > n:
        return False
    dense = _DENSE.findall(bare)
    if dense and sum(map(len, dense)) * 2 > len(bare) and any(map(_mixed, dense)):
        return True
    longer = [w for w in words if len(w) > 1 and w.isalpha()]
    return len(longer) >= 2 and sum(not _VOWEL.search(w) for w in longer) * 10 >= 6 * len(longer)


def _mixed(token: str) -> bool:
    """Letters of both cases, or letters and digits, mixed as no word mixes them."""
    flips = sum((a.isupper() != b.isupper()) or (a.isdigit() != b.isdigit()) for a, b in zip(token, token[1:]))
    return flips * 5 > len(token)


def row_period(kinds: list[bool], lengths: list[int], longest: int = 12) -> tuple[int, float]:
    """Shift at which value lines and line lengths agree best with themselves, and how well (0 to 1)."""
    n, best = len(kinds), (0, 0.0)
    for shift in range(2, min(longest, n // 2) + 1):
        pairs = n - shift
        same = sum(kinds[i] == kinds[i + shift] and abs(lengths[i] - lengths[i + shift]) <= 4 for i in range(pairs)) / pairs
        if same > best[1]:
            best = (shift, same)
    return best


def length_period(lengths: list[int], longest: int = 12) -> float:
    """By how much line lengths agree better at their best shift than at most others: 0 for even or random lines, near 1 for rows.
    Rows have to come back almost alike, two and a half times at least."""
    n = len(lengths)
    fits = [sum(abs(lengths[i] - lengths[i + shift]) <= 1 for i in range(n - shift)) / (n - shift) for shift in range(1, min(longest, n // 2) + 1)]
    if len(fits) < 2:
        return 0.0
    best = max(range(1, len(fits)), key=fits.__getitem__)
    if fits[best] < 0.85 or n * 2 < 5 * (best + 1):
        return 0.0
    others = sorted(f for k, f in enumerate(fits) if (k + 1) % (best + 1))
    return fits[best] - others[len(others) // 2] if others else 0.0


def gap_columns(lines: list[str]) -> list[bool]:
    """Which lines have a gap of two blanks or more that overlaps one of the line above or below."""
    spans = [[m.span() for m in _GAP.finditer(x)] for x in lines]

    def meet(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> bool:
        return any(lo < hi2 and lo2 < hi for lo, hi in a for lo2, hi2 in b)

    return [bool(s) and ((i > 0 and meet(s, spans[i - 1])) or (i + 1 < len(lines) and meet(s, spans[i + 1]))) for i, s in enumerate(spans)]


def hanging_items(indents: list[int], closed: list[bool]) -> int:
    """Items of a block in which first lines stand out and what goes on is deeper; 0 if deeper lines begin paragraphs, or there are none."""
    base = min(indents)
    deep = [w > base + 1 for w in indents]
    if deep[0] or not any(deep):
        return 0
    goes_on = sum(d and not closed[i - 1] for i, d in enumerate(deep))
    return deep.count(False) if goes_on * 5 >= 4 * sum(deep) else 0


def indent_period(indents: list[int], longest: int = 8) -> float:
    """How well the widths of the indents agree with themselves at their best shift; 0 where few lines, or nearly all, stand deeper."""
    n, base = len(indents), min(indents)
    if not n <= 5 * sum(w > base + 1 for w in indents) <= 4 * n:
        return 0.0
    return max((sum(indents[i] == indents[i + shift] for i in range(n - shift)) / (n - shift) for shift in range(2, n // 2 + 1 if n // 2 < longest else longest + 1)), default=0.0)


def block_kind(lines: list[str], stats: Counter) -> str:
    """Kind of a block of non-blank lines; adds its figures to the statistics."""
    n = len(lines)
    junk_chars = chars = common = words_n = letters = marked = ended = values = 0
    lines = [x.expandtabs(8) if x[0] == "\t" else x for x in lines]
    indents = [len(x) - len(x.lstrip()) for x in lines] if any(x[0] == " " for x in lines) else None
    in_columns = gap_columns(lines) if n > 1 and sum("  " in x for x in lines) > 1 else None
    is_closed: list[bool] = []
    cells: list[int] = []
    is_value: list[bool] = []
    short = 0
    for i, line in enumerate(lines):
        bare = line.strip()
        words = WORD.findall(bare.lower())
        size = len(bare)
        chars += size
        known = sum(map(_COMMON.__contains__, words))
        if _is_junk_line(bare, words, known):
            junk_chars += size
        words_n += len(words)
        letters += sum(map(len, words))
        common += known
        is_closed.append(bool(_CLOSED.search(bare)))
        marker = _MARKER.match(line)
        ended += len(_SENTENCE_END.findall(line, marker.end() if marker else 0))
        marked += bool(marker)
        short += len(words) <= 6
        if in_columns and in_columns[i]:
            parts = [c for c in _NARROW.split(bare.strip("|")) if c.strip()]
        else:
            parts = [c for c in _CELLS.split(bare.strip("|")) if c.strip()] if "\t" in bare or "|" in bare or "   " in bare else [bare]
        cells.append(len(parts))
        filled = [bool(_VALUE.fullmatch(c.strip())) for c in parts]
        values += sum(filled)
        is_value.append(len(parts) == 1 and filled[0])
    aligned = sum(c >= 2 and (c == cells[i - 1] if i else n > 1 and c == cells[1]) or (c >= 2 and i + 1 < n and cells[i + 1] == c) for i, c in enumerate(cells))
    closed = sum(is_closed)
    in_cells = sum(c >= 2 for c in cells)
    share = common / max(words_n, 1)
    stats["lines"] += n
    stats["words"] += words_n
    stats["word_chars"] += letters
    stats["chars"] += chars
    stats["common"] += common
    stats["closed_lines"] += closed
    stats["marked_lines"] += marked
    stats["aligned_lines"] += aligned
    stats["indented_lines"] += sum(map(bool, indents)) if indents else 0
    whole = "\n".join(lines)
    stats["symbols"] += len(_SYMBOL.findall(whole))
    columns = sum(in_columns) if in_columns else 0
    items = hanging_items(indents, is_closed) if indents else 0
    levels = indent_period(indents) if indents else 0.0
    kind = _decide(n, chars, junk_chars, words_n, share, marked, ended, short, cells, in_cells, aligned, values, is_value, items, levels, columns, lines)
    stats[kind + "_chars"] += len("".join(whole.split()))
    stats[kind + "_words"] += words_n
    return kind


def _decide(n, chars, junk_chars, words_n, share, marked, ended, short, cells, in_cells, aligned, values, is_value, items, levels, columns, lines) -> str:
    if junk_chars * 2 > chars:
        return "junk"
    if n > 1 and in_cells * 2 >= n and aligned * 2 >= in_cells and (values * 4 >= sum(cells) or share < 0.15):
        return "table"
    if n > 2 and columns * 10 >= 8 * n and aligned * 10 >= 8 * n:
        return "table"  # column on column, whatever stands in the cells
    if n == 1 and cells[0] >= 3 and (values * 2 >= cells[0] or share < 0.1):
        return "table"
    if n >= 4 and sum(is_value) * 3 >= n and short * 10 >= 9 * n:
        period, fit = row_period(is_value, [len(x) for x in lines])
        if fit >= 0.5 or sum(is_value) * 2 >= n:
            return "table"
    if items >= 2 and ended <= items and words_n <= 25 * items:
        return "list"  # hanging indents
    if n >= 4 and levels >= 0.6 and ended * 4 <= n and words_n <= 9 * n:
        return "list"  # levels of an outline
    if n >= 6 and short * 10 >= 9 * n and ended * 4 <= n and not marked and length_period([len(x.strip()) for x in lines]) >= 0.5:
        return "table"  # text cells, one under the other
    if n > 1 and marked * 10 >= 8 * n and ended * 10 <= 14 * n:  # every line an item; a numbered paragraph has more lines or sentences
        return "list"
    if marked * 10 >= 6 * n and n > 1 and share < 0.2 and words_n <= 9 * n:
        return "list"
    if n >= 3 and short * 10 >= 8 * n and share < 0.2 and ended * 4 <= n:
        return "list"
    if n == 1 and marked and share < 0.12 and not ended and 3 <= words_n <= 8:
        return "list"
    return "prose"


def profile(text: str | None) -> Counter:
    """Statistics of one text, with its visible characters and words by kind."""
    stats: Counter = Counter()
    block: list[str] = []
    for line in (text or "").splitlines():
        if line.strip():
            block.append(line)
        elif block:
            block_kind(block, stats)
            block = []
    if block:
        block_kind(block, stats)
    return stats


_SUMS = ("chars", "lines", "words", "word_chars", "common", "symbols", "closed_lines", "marked_lines", "aligned_lines", "indented_lines", *(f"{k}_chars" for k in KINDS), *(f"{k}_words" for k in KINDS))


def region_profiles(df: DataFrame, keys: tuple[str, ...], text: str = "text") -> DataFrame:
    """The profile of each row beside its keys."""

    def make():
        def run(*columns):
            profiles = [profile(t) for t in columns[-1]]
            return {f"k{i}": c for i, c in enumerate(columns[:-1])} | {s: [p[s] for p in profiles] for s in _SUMS}

        return run

    kinds = dict(df.dtypes)
    plain = {"bigint": "long", "int": "int", "string": "string"}
    ids = {f"k{i}": F.col(k) if kinds[k] in plain else F.col(k).cast("string") for i, k in enumerate(keys)}
    ddl = ", ".join(f"k{i} {plain.get(kinds[k], 'string')}" for i, k in enumerate(keys)) + "".join(f", {s} long" for s in _SUMS)
    return map_columns(df, {**ids, "text": text}, make, ddl).withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})


def document_statistics(df: DataFrame, doc_id: str = "doc_id", page: str = "page_no", node: str = "node_id", text: str = "text", created: str = "created_at", region_id: str = "region_id") -> DataFrame:
    """A row for each document: counts, ratios, and ``text_kind``."""
    narrow = df.select(F.col(doc_id).alias("doc_id"), F.col(page).cast("int").alias("page"), F.col(node).cast("int").alias("node"), F.unix_micros(F.col(created).cast("timestamp")).alias("at"), F.col(region_id).cast("long").alias("region"), F.col(text).alias("text"))
    rows = region_profiles(narrow, ("doc_id", "page", "node", "at", "region"))
    # The latest delivery of each node: a hash aggregate over one binary value, merged before the shuffle.
    figures = F.concat_ws(" ", *(F.col(s).cast("string") for s in _SUMS))
    latest = rows.groupBy("doc_id", "page", "node").agg(F.max_by(figures, F.struct(F.coalesce("at", F.lit(-(2**62))), F.coalesce("region", F.lit(-(2**62))))).alias("f"))
    parts = F.split("f", " ")
    sums = latest.select("doc_id", *(parts[i].cast("long").alias(s) for i, s in enumerate(_SUMS))).groupBy("doc_id").agg(*(F.sum(s).alias(s) for s in _SUMS), F.count("*").alias("regions"))

    def ratio(a: str, b: str):
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))

    total = sum((F.col(f"{k}_chars") for k in KINDS[1:]), F.col("prose_chars"))
    most = F.greatest(*(F.col(f"{k}_chars") for k in KINDS[1:]))
    kind = F.when(total == 0, None).when(F.col("prose_chars") * 2 >= total, "prose")
    for k in ("table", "list", "junk"):
        kind = kind.when(F.col(f"{k}_chars") == most, k)
    return sums.select(
        "doc_id", "regions", "lines", "words", "chars",
        ratio("word_chars", "words").alias("mean_word_length"), ratio("symbols", "chars").alias("symbol_ratio"), ratio("closed_lines", "lines").alias("closed_line_share"),
        ratio("common", "words").alias("common_word_share"), ratio("marked_lines", "lines").alias("marker_share"), ratio("aligned_lines", "lines").alias("alignment"), ratio("indented_lines", "lines").alias("indented_share"),
        *(F.col(f"{k}_chars") for k in KINDS), kind.alias("text_kind"),
    )


def not_prose(df: DataFrame, **columns: str) -> DataFrame:
    """Rows (doc_id, text_kind) of the documents of whose text the greater part is not prose."""
    return document_statistics(df, **columns).filter("text_kind <> 'prose'").select("doc_id", "text_kind")
