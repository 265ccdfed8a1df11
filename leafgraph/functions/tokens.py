"""Kinds of tokens, form lines and region categories, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafgraph.functions.textnorm import collapse, strip

# Patterns of the token kinds; Java syntax, with the Unicode classes of the originals.
_TIME = r"\d{1,2}:\d{2}"
_DATES = (
    r"\d{1,2}[/\-.]\d{1,2}[/\-.]\d{2,4}",
    r"\d{4}[/\-.]\d{1,2}[/\-.]\d{1,2}",
    r"\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{2,4}",
    r"(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+\d{4}",
)
_KEY = r"^(?:[A-Z][A-Za-z\s]{1,30}:$|[A-Z][A-Za-z\s]{1,30}\s*:)"
_CODE = r"^(?:[A-Z]{2,}\d{4,}$|\d{4,}-[A-Z\d]+$|[A-Z\d]{8,}$)"
_NUMBER = r"^(?:\d+$|\d+\.\d+$|\d{1,3}(?:,\d{3})*(?:\.\d+)?$|[$€£¥]\s*\d+)"
_CLOCK = r"\d{1,2}:\d{2}(?::\d{2})?\s*[aApP]\.?[mM]\.?|^\d{1,2}:\d{2}$|^\d{1,2}:\d{2}:\d{2}$"
KEYWORDS = "name address phone email date signature company title department position age gender id number code reference account customer total amount quantity price description".split()
STARTERS = "this that the it there here what when where which who how please if as we they you i he she our your his her my a an and or but".split()


def is_time(t: Column) -> Column:
    return t.rlike("(?U)" + _TIME)


def is_date(t: Column) -> Column:
    return t.rlike("(?iU)" + "|".join(_DATES))


def is_form_key(t: Column) -> Column:
    return t.rlike("(?U)" + _KEY) | F.regexp_replace(F.lower(t), ":+$", "").isin(KEYWORDS)


def is_code(t: Column) -> Column:
    return t.rlike("(?U)" + _CODE)


def is_number(t: Column) -> Column:
    return t.rlike("(?U)" + _NUMBER)


def is_time_value(t: Column) -> Column:
    """A time of day by itself, or with am or pm anywhere."""
    return t.rlike("(?U)" + _CLOCK)


def token_type(text: Column) -> Column:
    """empty, time, date, form_key, code, number or text: the first that holds."""
    t = strip(F.coalesce(text, F.lit("")))
    return F.when(t == "", "empty").when(is_time(t), "time").when(is_date(t), "date").when(is_form_key(t), "form_key").when(is_code(t), "code").when(is_number(t), "number").otherwise("text")


def classify_tokens(tokens: DataFrame, keys: list[str], near: float = 100.0) -> DataFrame:
    """Adds ``token_type``; a token becomes form_value if the one before it is (still) a form_key and their centres are close.

    Needs token_id and bounds (null bounds are never close). The sequential rule is solved without a loop: in each run of consecutive
    tokens that follow a close raw key, the odd ones become values. Tokens of one page are one window group."""
    w = Window.partitionBy(*keys).orderBy("token_id")
    cx, cy = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    t = tokens.withColumns({"_raw": token_type(F.col("text")), "_cx": cx, "_cy": cy})
    dx, dy = F.col("_cx") - F.lag("_cx").over(w), F.col("_cy") - F.lag("_cy").over(w)
    follows = (F.lag("_raw").over(w) == "form_key") & (F.sqrt(dx * dx + dy * dy) < near)
    t = t.withColumn("_c", F.coalesce(follows, F.lit(False)))
    t = t.withColumn("_run", F.sum(F.when(F.col("_c"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*keys, "_run").orderBy("token_id")
    place = F.row_number().over(inside) - 1  # the token that opens the run follows no key
    t = t.withColumn("token_type", F.when(F.col("_c") & (place % 2 == 1), "form_value").otherwise(F.col("_raw")))
    return t.drop("_raw", "_cx", "_cy", "_c", "_run")


def region_category(region_type: Column) -> Column:
    t = F.lower(F.coalesce(region_type, F.lit("")))
    exact = F.when(t == "form", "form").when(t == "table", "table").when(t.isin("figure", "chart", "plot", "graph"), "figure")
    return exact.when(t.contains("table"), "table").when(t.contains("form"), "form").when(t.contains("fig") | t.contains("chart") | t.contains("plot"), "figure").otherwise("text")


def word_count(text: Column) -> Column:
    t = collapse(F.coalesce(text, F.lit("")))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))


def is_long_text(text: Column, least: int = 40) -> Column:
    return word_count(text) >= least


def valid_key(key: Column) -> Column:
    """A label: not empty, short, few blanks, and not the beginning of a sentence."""
    first = F.lower(F.split(collapse(key), " ")[0])
    blanks = F.length(key) - F.length(F.replace(key, F.lit(" "), F.lit("")))
    return (key != "") & (F.length(key) <= 30) & (blanks <= 4) & ~key.contains("  ") & ~first.isin(STARTERS)


def form_line(text: Column) -> Column:
    """Struct (key, value) of a line that is one form field, else null."""
    pattern = r"(?U)^([A-Za-z][A-Za-z0-9\s\-_/.]{0,38}):\s*(.+)$"
    t = strip(text)
    key, value = strip(F.regexp_extract(t, pattern, 1)), strip(F.regexp_extract(t, pattern, 2))
    blanks = F.length(key) - F.length(F.replace(key, F.lit(" "), F.lit("")))
    ok = ~is_time_value(t) & t.rlike(pattern) & (F.length(key) <= 35) & (blanks <= 4) & (value != "")
    return F.when(ok, F.struct(key.alias("key"), value.alias("value")))
