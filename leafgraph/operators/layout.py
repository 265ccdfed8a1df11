"""Page layout: tokens to lines, lines to blocks, blocks to typed regions.

Input tokens have doc_id, token_id, text and bounds; a doc_id is one page image here. Pairs are found by joins on bins, never by pairing all
tokens of a page: two tokens can only be in one line if the right edge of one is near the left edge of the other, so the join key is
(page, vertical bin, edge bin). Everything after is windows and aggregates keyed by page and block.

Pages with a token without a box fail as a whole (``layout_failures``) and take no part. Lines of equal height are ordered by line id.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from leafgraph.config import LayoutConfig
from leafgraph.functions import geometry as g
from leafgraph.functions import tokens as T
from leafgraph.functions.textnorm import strip
from leafgraph.operators.components import components
from leafgraph.sources.tables import written

BOUNDS = ("xmin", "ymin", "xmax", "ymax")
KINDS = ("table", "form", "figure", "text")


def layout_failures(tokens: DataFrame) -> DataFrame:
    """Pages that can't be laid out, with the reason."""
    bad = F.exists(F.array(*BOUNDS), lambda v: v.isNull())
    return tokens.filter(bad).groupBy("doc_id").agg(F.lit("token without a box").alias("error"))


def usable(tokens: DataFrame) -> DataFrame:
    return tokens.join(layout_failures(tokens).select("doc_id"), "doc_id", "left_anti")


def medians(tokens: DataFrame, *keys: str, config: LayoutConfig = LayoutConfig()) -> DataFrame:
    """Exact medians of character width and token height."""
    n = F.length("text")
    return tokens.groupBy(*keys).agg(
        F.coalesce(F.median(F.when(n > 0, (F.col("xmax") - F.col("xmin")) / n)), F.lit(config.default_char_width)).alias("char_width"),
        F.coalesce(F.median(F.col("ymax") - F.col("ymin")), F.lit(config.default_line_height)).alias("line_height"),
    )


def _near_edges(df: DataFrame, id_: str, extra: list[str], across: tuple[str, str], reach: Column, band: tuple[Column, Column] | None) -> DataFrame:
    """Pairs (doc_id, a_*, b_*) where the upper edge of a and the lower edge of b (``across``) are closer than ``reach``, either way round.

    ``band``: first and last bin of a second direction that both must share; a pair is kept in its first shared bin only."""
    lo, hi = across
    # Cells four times the reach: a token stands in one, and its partners are sought in one or two.
    df = df.withColumns({"_w": 4 * F.greatest(reach, F.lit(1.0))}).withColumn("_reach", reach)
    if band:
        df = df.withColumns({"_b1": band[0], "_b2": band[1]}).withColumn("_bin", F.explode(F.sequence("_b1", "_b2")))
    else:
        df = df.withColumns({"_b1": F.lit(0), "_bin": F.lit(0)})
    cols = [id_, *BOUNDS, *extra]
    a = df.select("doc_id", "_bin", F.col("_b1").alias("_a1"), "_reach", F.floor(F.col(hi) / F.col("_w")).alias("_cell"), *(F.col(c).alias("a_" + c) for c in cols))
    near = F.sequence(F.floor((F.col(lo) - F.col("_reach")) / F.col("_w")), F.floor((F.col(lo) + F.col("_reach")) / F.col("_w")))
    b = df.select("doc_id", "_bin", F.col("_b1").alias("_c1"), F.explode(near).alias("_cell"), *(F.col(c).alias("b_" + c) for c in cols))
    pairs = a.join(b, ["doc_id", "_bin", "_cell"])
    return pairs.filter((F.col("_bin") == F.greatest("_a1", "_c1")) & (F.col("a_" + id_) != F.col("b_" + id_)) & (F.abs(F.col("a_" + hi) - F.col("b_" + lo)) < F.col("_reach")))


def token_pairs(tokens: DataFrame, config: LayoutConfig = LayoutConfig()) -> DataFrame:
    """Tokens that lie in one line: (doc_id, a, b)."""
    t = tokens.join(medians(tokens, "doc_id", config=config), "doc_id")
    pad, size = config.center_share * F.col("line_height"), 4 * F.greatest("line_height", F.lit(1.0))
    band = (F.floor((F.col("ymin") - pad) / size), F.floor((F.col("ymax") + pad) / size))
    p = _near_edges(t, "token_id", ["line_height"], ("xmin", "xmax"), config.gap_chars * F.col("char_width"), band)
    level = F.abs(g.center_y("a_") - g.center_y("b_")) < config.center_share * F.col("a_line_height")
    p = p.filter((g.overlap_y("a_", "b_") >= config.min_y_overlap) | level)
    return p.select("doc_id", F.col("a_token_id").alias("a"), F.col("b_token_id").alias("b"))


def tokens_of_lines(tokens: DataFrame, config: LayoutConfig = LayoutConfig(), stored: bool = False) -> DataFrame:
    """Tokens with the label of their line, the smallest token id in it. They are read three times, so they are written first if they aren't ``stored``."""
    tokens = tokens if stored else written(tokens, "tokens")
    labels = components(tokens.select("doc_id", F.col("token_id").alias("id")), token_pairs(tokens, config))
    return tokens.join(labels.withColumnRenamed("id", "token_id"), ["doc_id", "token_id"])


def _bounds(p: str = "") -> list[Column]:
    return [F.min(p + "xmin").alias("xmin"), F.min(p + "ymin").alias("ymin"), F.max(p + "xmax").alias("xmax"), F.max(p + "ymax").alias("ymax")]


def lines(labelled: DataFrame) -> DataFrame:
    """Lines (doc_id, line_id, label, text, bounds, tokens) from labelled tokens; text from left to right, lines from top to bottom."""
    order = F.array_sort(F.collect_list(F.struct(((F.col("xmin") + F.col("xmax")) / 2).alias("cx"), F.col("token_id").alias("id"), F.col("text").alias("t"))))
    one = labelled.groupBy("doc_id", "label").agg(F.array_join(F.transform(order, lambda x: x["t"]), " ").alias("text"), *_bounds(), F.count("*").alias("tokens"))
    w = Window.partitionBy("doc_id").orderBy((F.col("ymin") + F.col("ymax")) / 2, "label")
    return one.withColumn("line_id", F.row_number().over(w) - 1)


_FIELD = re.compile(r"([A-Za-z][A-Za-z0-9\s\-_/.]{0,35}):\s*([^:]+?)(?=\s+[A-Za-z][A-Za-z0-9\s\-_/.]{0,35}:|$)")
_SPLIT_TYPE = ArrayType(StructType([StructField("key", StringType()), StructField("value", StringType()), StructField("lo", DoubleType()), StructField("hi", DoubleType())]))


def split_fields(text: str) -> list[dict]:
    """Fields of a line that holds several, with where they begin and end as shares of its length; none if it holds one at most."""
    t = text.strip()
    found = list(_FIELD.finditer(t))
    if len(found) < 2:
        return []
    return [{"key": m[1].strip(), "value": m[2].strip(), "lo": m.start() / len(t), "hi": m.end() / len(t)} for m in found]


@F.pandas_udf(_SPLIT_TYPE)
def _split_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else split_fields(x))


def form_split(line_rows: DataFrame) -> DataFrame:
    """Lines with fields marked; a line of several fields becomes one line each, with its share of the width and no tokens. Renumbered."""
    several = (F.regexp_count("text", F.lit(r"[A-Za-z][A-Za-z0-9\s\-_/.]{0,35}:")) >= 2) & ~F.col("text").rlike(r"\d{1,2}:\d{2}")
    parts = F.coalesce(_split_udf(F.when(several, F.col("text"))), F.array().cast(_SPLIT_TYPE))
    many = F.regexp_count("text", F.lit(r"[A-Za-z][A-Za-z0-9\s\-_/.]{0,35}:")) >= 2
    field = T.form_line(F.col("text"))
    width = F.col("xmax") - F.col("xmin")
    whole = F.struct(
        F.lit(0).alias("part"), F.col("text"), F.col("xmin"), F.col("xmax"), (~many & field.isNotNull()).alias("is_form"), F.when(~many, field["key"]).alias("form_key"), F.when(~many, field["value"]).alias("form_value"),
        F.col("label"), F.col("tokens").cast("long").alias("tokens"),
    )

    def piece(x: Column, i: Column) -> Column:
        return F.struct(
            i.alias("part"), F.concat(x["key"], F.lit(": "), x["value"]).alias("text"), (F.col("xmin") + width * x["lo"]).alias("xmin"), (F.col("xmin") + width * x["hi"]).alias("xmax"), F.lit(True).alias("is_form"),
            x["key"].alias("form_key"), x["value"].alias("form_value"), F.lit(None).cast("long").alias("label"), F.lit(0).cast("long").alias("tokens"),
        )

    rows = line_rows.withColumn("_p", parts).select("doc_id", "line_id", "ymin", "ymax", F.explode(F.when(F.size("_p") > 0, F.transform("_p", piece)).otherwise(F.array(whole))).alias("r"))
    rows = rows.select("doc_id", F.col("line_id").alias("from_line"), "r.*", "ymin", "ymax")
    w = Window.partitionBy("doc_id").orderBy("from_line", "part")
    return rows.withColumn("line_id", F.row_number().over(w) - 1).drop("part", "from_line")


def line_pairs(line_rows: DataFrame, config: LayoutConfig = LayoutConfig()) -> DataFrame:
    """Lines of one block: (doc_id, a, b)."""
    width = line_rows.groupBy("doc_id").agg(F.median(F.col("xmax") - F.col("xmin")).alias("line_width"))
    p = _near_edges(line_rows.join(width, "doc_id"), "line_id", ["is_form", "line_width"], ("ymin", "ymax"), F.lit(config.line_gap), None)
    close = F.abs(F.col("a_xmin") - F.col("b_xmin")) < config.same_edge_share * F.col("a_line_width")
    both, none = F.col("a_is_form") & F.col("b_is_form"), ~F.col("a_is_form") & ~F.col("b_is_form")
    p = p.filter((both & close) | (none & (close | (g.overlap_x("a_", "b_") >= config.min_x_overlap))))
    return p.select("doc_id", F.col("a_line_id").alias("a"), F.col("b_line_id").alias("b"))


def lines_of_blocks(line_rows: DataFrame, config: LayoutConfig = LayoutConfig()) -> DataFrame:
    """Lines with block_id (by first line) and ``pos``, their place in the block from top to bottom."""
    labels = components(line_rows.select("doc_id", F.col("line_id").alias("id")), line_pairs(line_rows, config)).select("doc_id", F.col("id").alias("line_id"), F.col("label").alias("block"))
    rows = line_rows.join(labels, ["doc_id", "line_id"])
    rows = rows.withColumn("block_id", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("block")) - 1).drop("block")
    inside = Window.partitionBy("doc_id", "block_id").orderBy((F.col("ymin") + F.col("ymax")) / 2, "line_id")
    return rows.withColumn("pos", F.row_number().over(inside) - 1)


def key_values(block_lines: DataFrame) -> DataFrame:
    """Per block: share of lines that are label and value, mean length of the labels, and whether that is a pattern."""
    pattern = r"(?U)^([^:]{1,50}):\s*(.+)$"
    t = strip(F.col("text"))
    key, value = strip(F.regexp_extract(t, pattern, 1)), strip(F.regexp_extract(t, pattern, 2))
    hit = ~T.is_time_value(t) & t.rlike(pattern) & (key != "") & (F.length(key) < 50) & (value != "") & ~T.is_time_value(key)
    n = F.count_if(hit)
    out = block_lines.groupBy("doc_id", "block_id").agg(n.alias("keyvalue_lines"), F.count("*").alias("n_lines"), F.coalesce(F.avg(F.when(hit, F.length(key))), F.lit(0.0)).alias("avg_key_length"))
    ratio = F.col("keyvalue_lines") / F.col("n_lines")
    return out.withColumns({"keyvalue_ratio": ratio, "has_pattern": (ratio >= 0.4) & (F.col("keyvalue_lines") >= 2)})


def column_islands(points: DataFrame, eps: Column, *keys: str) -> DataFrame:
    """Density clusters of one dimension with two points or more: (keys, cluster, center). In one dimension that is exactly runs of sorted
    points without a gap above eps. Points are rows with ``cx`` and ``token_id``."""
    w = Window.partitionBy(*keys).orderBy("cx", "token_id")
    p = points.withColumn("_new", F.coalesce(F.col("cx") - F.lag("cx").over(w) > eps, F.lit(True)).cast("int"))
    p = p.withColumn("cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return p.groupBy(*keys, "cluster").agg(F.avg("cx").alias("center"), F.count("*").alias("n")).filter("n >= 2")


def _even(std: Column, mean: Column, floor: float = 1.0) -> Column:
    return 1 - F.least(F.lit(1.0), std / F.greatest(mean, F.lit(floor)))


def block_features(block_lines: DataFrame, labelled: DataFrame, config: LayoutConfig = LayoutConfig()) -> DataFrame:
    """One row a block with everything that the four detectors look at."""
    keys = ["doc_id", "block_id"]
    w = Window.partitionBy(*keys).orderBy("pos")
    cy = (F.col("ymin") + F.col("ymax")) / 2
    rows = block_lines.withColumns({"_len": F.length("text"), "_gap": cy - F.lag(cy).over(w)})
    counted = F.when(F.col("tokens") > 0, F.col("tokens"))
    shape = rows.groupBy(*keys).agg(
        F.count("*").alias("lines"), *_bounds(), F.avg("_len").alias("avg_len"), F.stddev_pop("_len").alias("sd_len"), F.avg("xmin").alias("m_left"), F.stddev_pop("xmin").alias("sd_left"),
        F.avg("xmax").alias("m_right"), F.stddev_pop("xmax").alias("sd_right"), F.avg((F.col("_len") < 40).cast("int")).alias("short_share"), F.avg((F.col("_len") > 60).cast("int")).alias("long_share"),
        F.avg("_gap").alias("m_gap"), F.stddev_pop("_gap").alias("sd_gap"), F.avg(counted).alias("m_tok"), F.stddev_pop(counted).alias("sd_tok"), F.count_if(F.col("tokens") >= 2).alias("multi"),
    )
    shape = shape.join(key_values(block_lines).select(*keys, "keyvalue_ratio", "has_pattern"), keys)
    home = block_lines.filter("label IS NOT NULL").select("doc_id", "block_id", "line_id", "label")
    tok = labelled.select("doc_id", "label", "token_id", "text", *BOUNDS).join(home, ["doc_id", "label"])
    return shape.join(_token_features(tok, shape, keys, config), keys, "left").fillna(0, ["num_cols", "text_cols", "aligned", "token_n", "ticks", "right_n", "full_cells"])


def _cells(lo: Column, hi: Column, columns: Column) -> Column:
    """Bits of five rows of ten cells: those of ``columns`` in the rows from lo to hi (0 to 4)."""
    first, last = F.greatest(lo, F.lit(0)).cast("int"), F.least(hi, F.lit(4)).cast("int")
    bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n)
    return F.when(first <= last, columns * ((bit(10 * (last + 1)) - bit(10 * first)) / 1023).cast("long")).otherwise(F.lit(0).cast("long"))


def _token_features(tok: DataFrame, shape: DataFrame, keys: list[str], config: LayoutConfig) -> DataFrame:
    """What the detectors look at among a block's tokens. All of it is windows and one aggregate over one partitioning by block.

    Columns are density clusters of token centres: runs without a gap above a reach. A column of two tokens or more shows as a token that
    opens a run and isn't followed by another such; a token can only be near the centre of its own run, as all others are farther than
    the reach. The middle of the block is a grid of ten by ten cells, kept as bits of two numbers."""
    around = Window.partitionBy(*keys)
    order = around.orderBy("cx", "token_id")
    tok = tok.join(shape.select(*keys, *(F.col(c).alias("b_" + c) for c in BOUNDS)), keys).withColumn("cx", (F.col("xmin") + F.col("xmax")) / 2)
    n = F.length("text")
    tok = tok.withColumn("_cw", F.coalesce(F.percentile(F.when(n > 0, (F.col("xmax") - F.col("xmin")) / n), F.lit(0.5)).over(around), F.lit(config.default_char_width)))
    wide, slim = F.greatest(F.lit(50.0), 5 * F.col("_cw")), F.greatest(F.lit(30.0), 3 * F.col("_cw"))
    gap = F.col("cx") - F.lag("cx").over(order)
    tok = tok.withColumns({"_wide": wide, "_opens": F.coalesce(gap > wide, F.lit(True)), "_slim": F.coalesce(gap > slim, F.lit(True))})
    alone = lambda c: F.coalesce(F.lead(c).over(order), F.lit(True))  # noqa: E731  the next token opens a run, too
    tok = tok.withColumns({"_run": F.sum(F.col("_opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)), "_column": F.col("_opens") & ~alone("_opens"), "_text": F.col("_slim") & ~alone("_slim")})
    run = Window.partitionBy(*keys, "_run")
    near = (F.count("*").over(run) >= 2) & (F.abs(F.col("cx") - F.avg("cx").over(run)) < F.col("_wide"))
    bw, bh = F.col("b_xmax") - F.col("b_xmin"), F.col("b_ymax") - F.col("b_ymin")
    at = lambda v, lo, ext: F.coalesce(F.try_divide(F.col(v) - F.col(lo), ext) * 20, F.lit(0.0)).cast("int")
    x1, x2 = F.greatest(at("xmin", "b_xmin", bw) - 5, F.lit(0)), F.least(at("xmax", "b_xmin", bw) - 5, F.lit(9))
    y1, y2 = at("ymin", "b_ymin", bh) - 5, at("ymax", "b_ymin", bh) - 5
    bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n)
    columns = F.when(x1 <= x2, bit(x2 + 1) - bit(x1)).otherwise(F.lit(0).cast("long"))
    bare = strip(F.col("text"))
    tick = bare.rlike(r"(?U)^-?\d+\.?\d*$") & (F.length(bare) <= 6)
    tok = tok.withColumns({"_near": near, "_tick": tick, "_right": F.col("xmin") > F.col("b_xmin") + 0.7 * bw, "_upper": _cells(y1, y2, columns), "_lower": _cells(y1 - 5, y2 - 5, columns)})
    return tok.groupBy(*keys).agg(
        F.count_if("_column").alias("num_cols"), F.count_if("_text").alias("text_cols"), F.count_distinct(F.when(F.col("_near"), F.col("line_id"))).alias("aligned"), F.count("*").alias("token_n"), F.count_if("_tick").alias("ticks"),
        F.count_if("_right").alias("right_n"), (F.bit_count(F.bit_or("_upper")) + F.bit_count(F.bit_or("_lower"))).alias("full_cells"),
    )


# Weights and limits of the four detectors.
TABLE_WEIGHTS = {"columns": 0.3, "stability": 0.25, "consistency": 0.2, "several": 0.15, "spacing": 0.1}
TABLE_FULL_COLUMNS, TABLE_LEAST_LINES, TABLE_LEAST_TOKENS = 10.0, 2, 5
FORM_PATTERN_SCORE, FORM_PATTERN_WEIGHT = 0.9, 0.1
FORM_WEIGHTS = {"colon": 0.4, "short": 0.3, "uneven": 0.2, "left": 0.1}
FORM_ELSE_WEIGHTS = {"colon": 0.3, "left": 0.2}
BOOSTS = {"pattern": -0.3, "form": -0.2}
JUSTIFIED_WEIGHTS = {"edges": 0.4, "long": 0.3, "length": 0.3}
JUSTIFIED_LIMITS = {"left": 0.8, "right": 0.7, "long": 0.5, "length": 50}
FIGURE_WEIGHTS = {"empty": 0.5, "ticks": 0.3, "legend": 0.2}
FIGURE_FULL_TICKS, FIGURE_LEGEND_TOKENS, FIGURE_CELLS = 10, 3, 100
TEXT_WEIGHTS = {"length": 0.5, "spacing": 0.5, "justified": 0.3}
FULL_LENGTH = 100


def hypotheses(features: DataFrame) -> DataFrame:
    """The four scores of each block, with the flag that each detector sets (which decides nothing)."""
    c = F.col
    one, n = F.lit(1.0), c("lines")
    consistency = F.coalesce(F.greatest(F.lit(0.0), 1 - c("sd_tok") / F.greatest(c("m_tok"), one)), F.lit(0.0))
    multi, stable = c("multi") / n, c("aligned") / n
    spread = F.when(c("m_gap") > 0, c("sd_gap") / c("m_gap")).otherwise(1.0)
    cols = c("num_cols")
    can_table = (n >= TABLE_LEAST_LINES) & (c("token_n") >= TABLE_LEAST_TOKENS)
    w = TABLE_WEIGHTS
    looks_table = cols / TABLE_FULL_COLUMNS * w["columns"] + stable * w["stability"] + consistency * w["consistency"] + multi * w["several"] + (1 - F.least(one, spread)) * w["spacing"]
    table = F.when(can_table, looks_table).otherwise(0.0)
    is_table = can_table & (cols >= 2) & (((stable >= 0.5) & (spread < 0.4)) | ((consistency >= 0.6) & (multi >= 0.6)) | ((cols >= 3) & (stable >= 0.4)))
    left, right = _even(c("sd_left"), c("m_left")), _even(c("sd_right"), c("m_right"))
    uneven = c("sd_len") / F.greatest(c("avg_len"), one)
    colon, short, long, avg = c("keyvalue_ratio"), c("short_share"), c("long_share"), c("avg_len")
    limit = JUSTIFIED_LIMITS
    justified = (left >= limit["left"]) & (right >= limit["right"]) & (long >= limit["long"]) & (avg > limit["length"])
    true_form = ((colon >= 0.25) & (short >= 0.3) & (uneven > 0.25)) | ((colon >= 0.1) & (left >= 0.65) & (right < 0.65) & (short >= 0.25))
    w = FORM_WEIGHTS
    looks_form = colon * w["colon"] + short * w["short"] + uneven * w["uneven"] + left * w["left"]
    otherwise = colon * FORM_ELSE_WEIGHTS["colon"] + left * FORM_ELSE_WEIGHTS["left"]
    form = F.when(n < 2, 0.0).when(c("has_pattern"), FORM_PATTERN_SCORE + colon * FORM_PATTERN_WEIGHT).when(justified, 0.0).when(true_form, looks_form).otherwise(otherwise)
    w = JUSTIFIED_WEIGHTS
    looks_justified = (left + right) / 2 * w["edges"] + long * w["long"] + F.least(one, avg / FULL_LENGTH) * w["length"]
    boost = F.when(n < 2, 0.0).when(c("has_pattern"), BOOSTS["pattern"]).when(justified, looks_justified).when(true_form, BOOSTS["form"]).otherwise(0.0)
    flat = (c("xmax") == c("xmin")) | (c("ymax") == c("ymin"))
    empty, legend = 1 - c("full_cells") / FIGURE_CELLS, c("right_n") >= FIGURE_LEGEND_TOKENS
    w = FIGURE_WEIGHTS
    figure = F.when(flat, 0.0).otherwise(empty * w["empty"] + F.least(one, c("ticks") / FIGURE_FULL_TICKS) * w["ticks"] + legend.cast("double") * w["legend"])
    even = F.coalesce(_even(c("sd_gap"), c("m_gap")), F.lit(0.0))
    jb = F.when(justified, TEXT_WEIGHTS["justified"]).otherwise(0.0)
    text = F.when(n < 2, 0.0).otherwise(F.least(one, F.least(one, avg / FULL_LENGTH) * TEXT_WEIGHTS["length"] + even * TEXT_WEIGHTS["spacing"] + jb + boost))
    is_text = (n >= 2) & (((avg >= 30) & (even >= 0.6) & (c("text_cols") <= 2)) | (jb > 0) | (boost > 0))
    flags = {"table": is_table, "form": (n >= 2) & (c("has_pattern") | (true_form & ~justified)), "figure": ~flat & (empty >= 0.3) & ((c("ticks") >= 5) | legend), "text": is_text}
    scores = {"table": table, "form": form, "figure": figure, "text": text}
    each = F.array(*(F.struct(F.lit(k).alias("type_ord"), F.lit(t).alias("region_type"), scores[t].cast("double").alias("score"), F.coalesce(flags[t], F.lit(False)).alias("flag")) for k, t in enumerate(KINDS)))
    return features.select("doc_id", "block_id", *BOUNDS, F.explode(each).alias("h")).select("doc_id", "block_id", "h.*", *BOUNDS)


def regions(scored: DataFrame, config: LayoutConfig = LayoutConfig()) -> DataFrame:
    """The best two hypotheses of each block that reach the least score of their type, numbered by block and rank."""
    w = Window.partitionBy("doc_id", "block_id").orderBy(F.desc(F.round("score", 9)), "type_ord")  # equal but for the last bits is equal
    least = F.create_map(*(F.lit(x) for kv in config.min_scores.items() for x in kv))
    top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= config.top_hypotheses).filter(F.col("score") >= F.element_at(least, F.col("region_type")))
    return top.withColumn("region_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("block_id", "rank")) - 1)


def analyze(tokens: DataFrame, config: LayoutConfig = LayoutConfig()) -> dict[str, DataFrame]:
    """All stages: labelled tokens, lines, block lines, hypotheses and regions. What several stages read is written once."""
    labelled = written(tokens_of_lines(usable(written(tokens, "pages")), config, stored=True), "tokens")
    raw = lines(labelled)
    block_lines = written(lines_of_blocks(written(form_split(raw), "lines"), config), "blocks")
    scored = hypotheses(block_features(block_lines, labelled, config))
    return {"tokens": labelled, "lines": raw, "block_lines": block_lines, "hypotheses": scored, "regions": regions(scored, config)}


def region_nodes(result: dict[str, DataFrame], line_separator: str = " ", most: int | None = 200) -> DataFrame:
    """Regions as graph nodes: (doc_id, page_no, node_id, region_type, bounds, score, text, is_short). Questions take whole texts (``most`` None)
    with their line breaks."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "text")))
    text = result["block_lines"].groupBy("doc_id", "block_id").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), line_separator).alias("text"), F.count("*").alias("_n"), F.sum(F.length("text")).alias("_c"))
    r = result["regions"].join(text, ["doc_id", "block_id"])
    short = (F.col("region_type") == "text") & (F.col("_n") <= 3) & (F.col("_c") < 150)
    return r.select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(1).alias("page_no"), F.col("region_id").alias("node_id"), "region_type", *BOUNDS, "score", (F.col("text") if most is None else F.substring("text", 1, most)).alias("text"), short.alias("is_short"))
