"""Text normalisation and fuzzy matching as column expressions.

Only Unicode normal forms and the expansion of 1.5K need Python; those run as Arrow-batched functions that get null for rows they would
not change, so such rows cost no serialisation of text.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from leafgraph.config import NormConfig

#: All white space that str.split() knows, for both Java and RE2.
WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Characters that a recogniser confuses, and what they become.
OCR_FROM, OCR_TO = "OlISZ|¢§", "01152Ics"


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


@F.pandas_udf(StringType())
def _no_accents(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn"))


_ABBREVIATED = re.compile(r"([\d,.]+)\s*([KMB])\b", re.I)
_TIMES = {"K": 1e3, "M": 1e6, "B": 1e9}


def expand_abbreviations(text: str) -> str:
    def expand(m: re.Match) -> str:
        try:
            return str(int(float(m[1].replace(",", "")) * _TIMES[m[2].upper()]))
        except (ValueError, OverflowError):
            return m[0]

    return _ABBREVIATED.sub(expand, text)


@F.pandas_udf(StringType())
def _expanded(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else expand_abbreviations(x))


def _only_where(fn, text: Column, pattern: str) -> Column:
    return F.coalesce(fn(F.when(text.rlike(pattern), text)), text)


def nfc(text: Column) -> Column:
    return _only_where(_nfc, text, r"[^\x00-\x7F]")


def remove_accents(text: Column) -> Column:
    return _only_where(_no_accents, text, r"[^\x00-\x7F]")


def fix_ocr(text: Column) -> Column:
    """Confusable characters, everywhere; then a bar between or beside digits becomes a one."""
    t = F.translate(text, OCR_FROM, OCR_TO)
    t = F.regexp_replace(t, r"(?U)(\d)I(\d)", "$11$2")
    t = F.regexp_replace(t, r"(?U)^I(\d)", "1$1")
    return F.regexp_replace(t, r"(?U)(\d)I$", "$11")


def normalize_numbers(text: Column) -> Column:
    t = F.regexp_replace(text, "[$€£¥₹]", "")
    t = _only_where(_expanded, t, r"(?iU)[\d,.]\s*[KMB]\b")
    for _ in range(2):
        t = F.regexp_replace(t, r"(?U)(\d),(\d{3})", "$1$2")
    return F.regexp_replace(t, r"(?U)(\d)%", "$1")


def remove_punctuation(text: Column) -> Column:
    t = F.regexp_replace(text, r"(?U)[^\w\s'\-]", " ")
    t = F.regexp_replace(t, r"(?U)(?<!\w)'|'(?!\w)", "")
    return F.regexp_replace(t, r"(?U)(?<!\w)-|-(?!\w)", " ")


def collapse(text: Column) -> Column:
    """White space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(text, WS + "+", " "))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WS}+|{WS}+$", "")


def _steps(text: Column, c: NormConfig, preserve_case: bool, python: bool) -> Column:
    t = F.coalesce(text, F.lit(""))
    if python:
        t = nfc(t)
        t = remove_accents(t) if c.remove_accents else t
    t = fix_ocr(t) if c.fix_ocr_errors else t
    if c.normalize_numbers:
        t = normalize_numbers(t) if python else _numbers_without_python(t)
    t = F.lower(t) if c.lowercase and not preserve_case else t
    t = remove_punctuation(t) if c.remove_punctuation else t
    t = collapse(t) if c.normalize_whitespace else t
    return strip(t)


def _numbers_without_python(t: Column) -> Column:
    t = F.regexp_replace(t, "[$€£¥₹]", "")
    for _ in range(2):
        t = F.regexp_replace(t, r"(?U)(\d),(\d{3})", "$1$2")
    return F.regexp_replace(t, r"(?U)(\d)%", "$1")


def normalize(text: Column, config: NormConfig = NormConfig(), preserve_case: bool = False) -> Column:
    """The steps in their fixed order; null gives the empty text."""
    return _steps(text, config, preserve_case, python=True)


def normalize_again(text: Column, config: NormConfig = NormConfig()) -> Column:
    """Normalisation of text that is normal already. It isn't idempotent: what was lowered may be confusable now."""
    return _steps(text, config, False, python=False)


def for_matching(text: Column) -> Column:
    return normalize(text, NormConfig(remove_punctuation=True, normalize_numbers=True))


def for_display(text: Column) -> Column:
    return normalize(text, NormConfig(lowercase=False))


def words(text: Column) -> Column:
    """Words of collapsed text; none for the empty text."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common words of two normalised texts; 1 if equal (even if both are empty), 0 if one is empty."""
    wa, wb = words(a), words(b)
    common, union = F.size(F.array_intersect(wa, wb)), F.size(F.array_union(wa, wb))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(F.try_divide(common.cast("double"), union))


def similarity(a: Column, b: Column, config: NormConfig = NormConfig(remove_punctuation=True, normalize_numbers=True)) -> Column:
    return jaccard(normalize(a, config), normalize(b, config))


def answer_span(answer: Column, context: Column, config: NormConfig = NormConfig(), threshold: float = 0.8) -> Column:
    """Struct (start, stop, similarity) of the answer in the context, both normalised: its first exact place, else the first of the most
    similar windows of as many words at or above the threshold, else (-1, -1, 0). Arguments should be materialised columns."""
    exact = F.when(answer == "", 0).otherwise(F.instr(context, answer) - 1)
    want, have = words(answer), words(context)
    size, again = F.size(want), normalize_again(answer, config)
    last = F.size(have) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def scored(i: Column) -> Column:
        window = F.array_join(F.slice(have, i + 1, size), " ")
        return F.struct(jaccard(again, normalize_again(window, config)).alias("s"), (-i).alias("i"), window.alias("w"))

    best = F.array_max(F.filter(F.transform(starts, scored), lambda x: x["s"] >= threshold))
    at = F.instr(context, best["w"]) - 1
    none = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("stop"), F.lit(0.0).alias("similarity"))
    hit = F.struct(exact.alias("start"), (exact + F.length(answer)).alias("stop"), F.lit(1.0).alias("similarity"))
    fuzzy = F.struct(at.alias("start"), (at + F.length(best["w"])).alias("stop"), best["s"].alias("similarity"))
    return F.when(exact >= 0, hit).when(best.isNotNull() & (size > 0), fuzzy).otherwise(none)


def normalized_rows(df, column: str = "text", config: NormConfig = NormConfig()):
    """Tokens or lines with their normal form; the text as it was stays in ``original_text``."""
    return df.withColumn("original_text", F.col(column)).withColumn(column, normalize(F.col(column), config))


def sentences(text: Column) -> Column:
    """The pieces between full stops, exclamation and question marks."""
    return F.split(F.coalesce(text, F.lit("")), "[.!?]")
