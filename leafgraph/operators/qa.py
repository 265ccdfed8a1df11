"""Question-answer rows from region graphs: form fields, table cells, figures, titles, summaries; de-duplication and quality rules.

Every generator is a projection or an explode of the node rows; where order matters (caps, first-wins), rows carry the place that the
sequential rules would give them and windows over a page's rows decide. Pages are small, so no window group can grow with the corpus.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from leafgraph.config import QAConfig
from leafgraph.functions import tokens as T
from leafgraph.functions.textnorm import collapse, strip
from leafgraph.operators.graph import KEYS

# The texts of questions and answers; braces stand for what is put in.
ASK_FIELD = "What is the {}?"
ASK_HEADERS = "What are the column headers in the table?"
ASK_ROWS = "How many data rows are in the table (excluding the header)?"
ASK_CELL = "What is the {} for {}?"
ASK_FIGURE = "What does the figure show?"
ASK_TABLE_TITLE = "What information does '{}' present?"
ASK_FIGURE_TITLE = "What does '{}' illustrate?"
ASK_SUMMARY = "What is the main topic or content discussed in this section?"
SAY_ROWS = "Data rows detected: {}"
SAY_COLUMNS = "The table shows data with columns: {}."
SAY_MORE_ROWS = " It contains {} data rows."
SAY_FIGURE = "The figure illustrates the referenced data."
ASK_OTHER_TITLE = "What is the content related to '{}'?"
WHY_FIELD = "Extracted value for '{}' from form field."
WHY_HEADERS = "The header row contains the table's column names."
WHY_ROWS = "Counted the number of non-header rows parsed from the table."
WHY_CELL = "Looked up the cell at the intersection of the selected row and column."
WHY_FIGURE = "Answered using the figure's extracted description text."
WHY_SUMMARY = "Summarized the main content from the text region."
WHY_TITLE = "Connected the title/caption with its {} content."


def filled(template: str, *values: Column) -> Column:
    """A text with its braces filled from columns."""
    parts = template.split("{}")
    return F.concat(F.lit(parts[0]), *(x for v, p in zip(values, parts[1:]) for x in (v, F.lit(p))))


LINES = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"

# --- forms --------------------------------------------------------------------------------------------------------------------------
_CLOCK = re.compile(r"\d{1,2}:\d{2}(?::\d{2})?\s*[aApP]\.?[mM]\.?|^\d{1,2}:\d{2}$|^\d{1,2}:\d{2}:\d{2}$")
_BLANKS = re.compile(" +")
_STARTERS = frozenset(T.STARTERS)


def _is_label(key: str) -> bool:
    return bool(key) and len(key) <= 30 and key.count(" ") <= 4 and "  " not in key and key.split()[0].lower() not in _STARTERS and not _CLOCK.search(key)


def _label_start(segment: str) -> int:
    """Where the last capital stands that blanks part from the end of a value (a small letter, digit or mark); 0 if there is none."""
    start = 0
    for m in _BLANKS.finditer(segment):
        before, after = segment[m.start() - 1 : m.start()], segment[m.end() : m.end() + 1]
        if after.isupper() and before and (before.islower() or before.isdigit() or before in ".,;"):
            start = m.end()
    return start


def fields_of_line(line: str) -> list[tuple[str, str]]:
    """Fields of a stripped line with several colons: a label reaches back from its colon to the last capital that follows the end of
    a value, and its value runs to the start of the next label."""
    labels: list[tuple[int, int, str]] = []  # start of the label, its colon, the label
    after = 0
    for m in re.finditer(":", line):
        segment = line[after : m.start()]
        start = _label_start(segment) if after else 0
        if _is_label(key := segment[start:].strip()):
            labels.append((after + start, m.start(), key))
            after = m.end()
    ends = [start for start, _, _ in labels[1:]] + [len(line)]
    found = [(key, line[colon + 1 : end].strip()) for (_, colon, key), end in zip(labels, ends)]
    return [(k, v) for k, v in found if v and not _CLOCK.search(v)]


@F.pandas_udf(ArrayType(StructType([StructField("key", StringType()), StructField("value", StringType())])))
def _many_fields(lines: pd.Series) -> pd.Series:
    return lines.map(lambda x: None if x is None else [{"key": k, "value": v} for k, v in fields_of_line(x)])


def form_fields(df: DataFrame, *ids: str, text: str = "text") -> DataFrame:
    """Rows (ids, line, field, key, value). Lines with one colon stay in the JVM; only those with more go to Python."""
    lines = df.select(*ids, F.posexplode(F.split(F.col(text), LINES)).alias("line", "_l")).withColumn("_l", strip(F.col("_l")))
    lines = lines.filter(F.col("_l").contains(":") & ~T.is_time_value(F.col("_l")))
    colons = F.length("_l") - F.length(F.replace("_l", F.lit(":"), F.lit("")))
    key, value = strip(F.substring_index("_l", ":", 1)), strip(F.expr("substring(_l, locate(':', _l) + 1)"))
    single = F.when(T.valid_key(key) & (value != "") & ~T.is_time_value(key), F.array(F.struct(key.alias("key"), value.alias("value"))))
    many = _many_fields(F.when(colons > 1, F.col("_l")))
    return lines.select(*ids, "line", F.posexplode(F.when(colons == 1, single).otherwise(many)).alias("field", "_f")).select(*ids, "line", "field", "_f.*")


# --- tables -------------------------------------------------------------------------------------------------------------------------
def split_row(row: Column) -> Column:
    """Cells of a table row: by bars, tabs or wide gaps; else the last word by itself if it holds a digit; else one cell."""
    row = F.regexp_replace(strip(row), r"^\|+|\|+$", "")
    parts = lambda pattern: F.filter(F.transform(F.split(row, pattern), strip), lambda c: c != "")
    by_bar, by_tab, wide = parts(r"\|"), parts("\t"), parts(r"(?U)\s{2,}")
    bare = collapse(row)
    ws = F.split(bare, " ")
    last = F.element_at(ws, -1)
    with_value = (F.size(ws) >= 3) & last.rlike(r"(?U)\d")
    rest = F.array(F.array_join(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(1))), " "), last)
    lone = F.when(row == "", F.array().cast("array<string>")).when(with_value, rest).otherwise(F.array(row))
    return F.when(row.contains("|"), by_bar).when(row.contains("\t"), by_tab).when(row.contains("  ") & (F.size(wide) >= 2), wide).otherwise(lone)


def parse_table(text: Column) -> Column:
    """Rows of at least two cells."""
    rows = F.transform(F.filter(F.split(text, LINES), lambda x: strip(x) != ""), split_row)
    return F.filter(rows, lambda r: F.size(r) >= 2)


def column_modes(nodes: DataFrame) -> DataFrame:
    """The most frequent number of cells of each table's rows (the one seen first if several are), and its rows of two cells or more."""
    t = _of(nodes, "table").withColumn("n", F.transform(F.filter(F.split(F.coalesce("text", F.lit("")), LINES), lambda x: strip(x) != ""), lambda x: F.size(split_row(x))))
    each = t.select(*KEYS, "node_id", F.posexplode("n").alias("at", "n")).filter("n > 0").groupBy(*KEYS, "node_id", "n").agg(F.count("*").alias("rows"), F.min("at").alias("at"))
    full = F.sum(F.when(F.col("n") >= 2, F.col("rows")).otherwise(0))
    return each.groupBy(*KEYS, "node_id").agg(F.max_by("n", F.struct("rows", -F.col("at"))).alias("columns"), full.alias("table_rows"))


def _qa(question: Column, answer: Column, regions: Column, quotes: Column, kind: str, why: Column) -> Column:
    return F.struct(
        question.alias("question"), answer.alias("answer"), regions.alias("evidence_region_ids"), quotes.alias("evidence_quotes"), F.lit(kind).alias("reasoning_type"), why.alias("reasoning_explanation")
    )


def _listed(df: DataFrame, qas: Column, most: int) -> DataFrame:
    """Keys, node, place and the fields of each of the first ``most`` rows."""
    return df.select(*KEYS, "node_id", F.posexplode(F.slice(qas, 1, most)).alias("place", "q")).select(*KEYS, "node_id", "place", "q.*")


def _of(nodes: DataFrame, *kinds: str) -> DataFrame:
    return nodes.withColumn("category", T.region_category(F.col("region_type"))).filter(F.col("category").isin(*kinds))


def form_qas(nodes: DataFrame, config: QAConfig = QAConfig()) -> DataFrame:
    f = form_fields(_of(nodes, "form"), *KEYS, "node_id")
    w = Window.partitionBy(*KEYS, "node_id").orderBy("line", "field")
    f = f.withColumn("place", F.row_number().over(w) - 1).filter(F.col("place") < config.max_form)
    q = _qa(filled(ASK_FIELD, F.col("key")), F.col("value"), F.array("node_id"), F.array(F.concat("key", F.lit(": "), "value")), "lookup", filled(WHY_FIELD, F.col("key")))
    return f.select(*KEYS, "node_id", "place", q.alias("q")).select(*KEYS, "node_id", "place", "q.*")


def table_qas(nodes: DataFrame, config: QAConfig = QAConfig()) -> DataFrame:
    t = _of(nodes, "table").withColumn("rows", parse_table(F.coalesce("text", F.lit("")))).filter(F.size("rows") > 0)
    header, data = F.col("rows")[0], F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(0)))
    me = F.array("node_id")
    n = F.size("rows") - 1
    first = _qa(F.lit(ASK_HEADERS), F.array_join(header, ", "), me, F.array(F.array_join(header, " | ")), "lookup", F.lit(WHY_HEADERS))
    count = _qa(F.lit(ASK_ROWS), n.cast("string"), me, F.array(filled(SAY_ROWS, n.cast("string"))), "lookup", F.lit(WHY_ROWS))

    def cell(r: Column) -> Column:
        return _qa(filled(ASK_CELL, header[1], r[0]), r[1], me, F.array(F.array_join(r, " | ")), "lookup", F.lit(WHY_CELL))

    cells = F.transform(F.filter(F.slice(data, 1, 3), lambda r: r[1] != ""), cell)
    return _listed(t, F.concat(F.array(first, count), cells), config.max_table)


def figure_qas(nodes: DataFrame, config: QAConfig = QAConfig()) -> DataFrame:
    f = _of(nodes, "figure").withColumn("t", collapse(F.coalesce("text", F.lit("")))).filter("t <> ''")
    q = _qa(F.lit(ASK_FIGURE), F.col("t"), F.array("node_id"), F.array(F.substring("text", 1, config.quote_chars)), "lookup", F.lit(WHY_FIGURE))
    return _listed(f, F.array(q), config.max_figure)


# --- titles and summaries -----------------------------------------------------------------------------------------------------------
# Words that mark a title above, and a caption below, a table or figure.
ABOVE_WORDS = ("table", "figure", "fig.", "tab.", "chart", "exhibit")
BELOW_WORDS = ("table", "figure", "fig.", "tab.", "chart", "source", "note")


def titles(nodes: DataFrame, edges: DataFrame, config: QAConfig = QAConfig()) -> DataFrame:
    """The title or caption of each table and figure: (keys, node_id, category, text, title_id, title)."""
    content = _of(nodes, "table", "figure").select(*KEYS, "node_id", "category", "text", F.col("ymin").alias("y1"), F.col("ymax").alias("y2"))
    low, high = config.title_words
    near = _of(nodes, "text").select(*KEYS, F.col("node_id").alias("title_id"), collapse(F.coalesce("text", F.lit(""))).alias("title"), F.col("ymin").alias("t1"), F.col("ymax").alias("t2"))
    near = near.filter(T.word_count(F.col("title")).between(low, high))
    links = edges.select(*KEYS, F.col("source").alias("node_id"), F.col("target").alias("title_id"), "rank")
    c = content.join(links, [*KEYS, "node_id"]).join(near, [*KEYS, "title_id"])
    is_above, is_below = F.col("t2") < F.col("y1"), F.col("t1") > F.col("y2")
    has = lambda ws: F.exists(F.array(*map(F.lit, ws)), lambda w: F.contains(F.lower(F.col("title")), w))
    c = c.filter(is_above | is_below).withColumns({
        "_k": F.when(is_above, has(ABOVE_WORDS)).otherwise(has(BELOW_WORDS)), "_d": F.when(is_above, F.col("y1") - F.col("t2")).otherwise(F.col("t1") - F.col("y2")), "_a": is_above,
    })
    w = Window.partitionBy(*KEYS, "node_id").orderBy(F.desc("_k"), "_d", F.desc("_a"), "rank")
    return c.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*KEYS, "node_id", "category", "text", "title_id", "title")


def title_content(pairs: DataFrame, config: QAConfig = QAConfig()) -> DataFrame:
    """A question for each pair of a title and its content: (keys, node_id, category, text, title_id, title) of any category."""
    t = pairs.withColumns({"t": collapse(F.coalesce("text", F.lit(""))), "rows": parse_table(F.coalesce("text", F.lit("")))})
    is_table, is_figure = F.col("category") == "table", F.col("category") == "figure"
    question = F.when(is_table, filled(ASK_TABLE_TITLE, F.col("title"))).when(is_figure, filled(ASK_FIGURE_TITLE, F.col("title"))).otherwise(filled(ASK_OTHER_TITLE, F.col("title")))
    n = F.size("rows")
    columns = filled(SAY_COLUMNS, F.array_join(F.get("rows", F.lit(0)), ", "))
    counted = F.when(n > 1, filled(SAY_MORE_ROWS, (n - 1).cast("string"))).otherwise("")
    start = F.substring("t", 1, config.fallback_chars)
    answer = F.when(is_table & (n > 0), F.concat(columns, counted)).when(is_figure, F.when(F.col("t") != "", F.col("t")).otherwise(SAY_FIGURE)).otherwise(start)
    q = _qa(question, answer, F.array("title_id", "node_id"), F.array("title", F.substring("t", 1, config.quote_chars)), "coreference", filled(WHY_TITLE, F.col("category")))
    return _listed(t, F.array(q), 1)


def title_qas(nodes: DataFrame, edges: DataFrame, config: QAConfig = QAConfig()) -> DataFrame:
    return title_content(titles(nodes, edges, config), config)


def summary_qas(nodes: DataFrame, config: QAConfig = QAConfig()) -> DataFrame:
    """A summary question for each of a page's longest long texts; ``place`` is the rank by length."""
    t = _of(nodes, "text").filter(T.is_long_text(F.col("text"), config.long_words)).withColumn("t", collapse(F.col("text")))
    w = Window.partitionBy(*KEYS).orderBy(F.desc(F.length("text")), "node_id")
    t = t.withColumn("place", F.row_number().over(w) - 1).filter(F.col("place") < config.longest_texts)
    ws = F.split("t", " ")
    short = F.array_join(F.slice(ws, 1, config.summary_words), " ")
    answer = F.when(F.size(ws) > config.summary_words, F.concat(short, F.lit("..."))).otherwise(short)
    q = _qa(F.lit(ASK_SUMMARY), answer, F.array("node_id"), F.array(F.substring("t", 1, config.quote_chars)), "comprehension", F.lit(WHY_SUMMARY))
    return t.select(*KEYS, "node_id", "place", q.alias("q")).select(*KEYS, "node_id", "place", "q.*")


# --- all of a document --------------------------------------------------------------------------------------------------------------
def first_questions(df: DataFrame, keys: list[str], order: list[Column | str], most: int | None = None, question: str = "question") -> DataFrame:
    """The first row of each question (white space apart) within its keys, blank ones dropped, at most ``most``, with its place ``idx``.

    The first of equal questions is found by a hash aggregate, which combines before the shuffle: a question that a group repeats a
    million times is one row afterwards."""
    q = collapse(F.coalesce(question, F.lit("")))
    rest = [c for c in df.columns if c not in keys]
    firsts = df.withColumn("_q", q).filter("_q <> ''").groupBy(*keys, "_q").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = firsts.withColumn("idx", F.row_number().over(w) - 1)
    return ranked if most is None else ranked.filter(F.col("idx") < most)


def generate_qas(nodes: DataFrame, edges: DataFrame, config: QAConfig = QAConfig(), model_qas: DataFrame | None = None) -> DataFrame:
    """All questions of each page: rules by node, then titles, long texts and (if given) a model's, first of each question, capped."""
    def part(df: DataFrame, n: int) -> DataFrame:
        return df.withColumns({"part": F.lit(n), "major": F.col("node_id"), "minor": F.col("place")})

    rules = part(form_qas(nodes, config), 0).unionByName(part(table_qas(nodes, config), 0)).unionByName(part(figure_qas(nodes, config), 0))
    text = part(title_qas(nodes, edges, config), 1).unionByName(summary_qas(nodes, config).withColumns({"part": F.lit(2), "major": F.col("place"), "minor": F.lit(0)}))
    if model_qas is not None:
        text = text.unionByName(part(model_qas, 3))
    w = Window.partitionBy(*KEYS).orderBy("part", "major", "minor")
    text = text.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= config.max_text).drop("_r")
    return first_questions(rules.unionByName(text), list(KEYS), ["part", "major", "minor"], config.max_per_document).drop("part", "major", "minor", "place")


def csv_rows(qas: DataFrame, split: Column) -> DataFrame:
    """The ten columns of the question file; lists as JSON text."""
    doc = F.concat_ws("_", "doc_id", F.col("page_no").cast("string"))
    return qas.select(
        split.alias("split"), doc.alias("doc_id"), F.concat(doc, F.lit(".png")).alias("image_file"), F.concat_ws("_", doc, F.col("idx").cast("string")).alias("qa_id"), "question", "answer", "reasoning_type",
        "reasoning_explanation", F.to_json("evidence_region_ids").alias("evidence_region_ids"), F.to_json("evidence_quotes").alias("evidence_quotes"),
    )


# --- models and their output --------------------------------------------------------------------------------------------------------
def json_in_text(text: Column, schema: str = "map<string,string>") -> Column:
    """The object in a model's reply: fenced blocks first, then the whole reply, then from the first to the last brace; null if none parses."""
    t = strip(text)
    fenced = F.regexp_extract_all(t, F.lit(r"(?is)```(?:json)?\s*(\{.*?\})\s*```"), 1)
    parsed = F.filter(F.transform(fenced, lambda b: F.from_json(b, schema)), lambda m: m.isNotNull() & (F.size(m) > 0))
    outer = F.from_json(F.regexp_extract(t, r"(?s)(\{.*\})", 1), schema)
    full = lambda m: F.when(F.size(m) > 0, m)
    return F.coalesce(F.get(parsed, F.lit(0)), full(F.from_json(t, schema)), full(outer))


#: The names in braces that a prompt may hold, by the end of the pair that fills them.
PLACEHOLDERS = {"a": ("source_id", "figure_id", "text1_id", "table1_id", "form_id"), "b": ("target_id", "caption_id", "text2_id", "table2_id", "conclusion_id")}


def prompt(template: Column, a: dict[str, Column], b: dict[str, Column]) -> Column:
    """A template with its placeholders filled from two nodes (id, type and text each); other braces stay."""
    out = template
    for end, node, name in (("a", a, "source"), ("b", b, "target")):
        values = {k: node["id"].cast("string") for k in PLACEHOLDERS[end]} | {f"{name}_type": F.coalesce(node["type"], F.lit("TextBlock")), f"{name}_text": F.coalesce(node["text"], F.lit(""))}
        for k, v in values.items():
            out = F.replace(out, F.lit("{" + k + "}"), v)
    return out


# The prompt template for each pair of categories, whichever comes first.
TEMPLATE_OF = {
    ("text", "table"): "text_table_validation",
    ("figure", "text"): "figure_caption_mapping",
    ("text", "text"): "text_text_coreference",
    ("table", "table"): "table_table_crosscheck",
    ("form", "text"): "form_conclusion",
}


def template_key(a: Column, b: Column) -> Column:
    """The template for two categories; null if there is none."""
    out = F.lit(None).cast("string")
    for (x, y), key in TEMPLATE_OF.items():
        out = F.when(((a == x) & (b == y)) | ((a == y) & (b == x)), key).otherwise(out)
    return out


def with_templates(pairs: DataFrame, templates: DataFrame) -> DataFrame:
    """Pairs with the row of their template (template, reasoning_type, prompt_template); pairs without one are left out."""
    return pairs.join(templates, "template")


def evidence_nodes(qas: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes that each question's evidence names: (keys, idx, place, node_id, region_type, bounds); ids of no node are left out."""
    each = qas.select(*KEYS, "idx", F.posexplode("evidence_region_ids").alias("place", "node_id"))
    return each.join(nodes.select(*KEYS, "node_id", "region_type", "xmin", "ymin", "xmax", "ymax"), [*KEYS, "node_id"])


def model_pairs(nodes: DataFrame, edges: DataFrame, text_words: int = 20) -> DataFrame:
    """Pairs worth a model's question: a table with its first long text neighbour, a figure with its first caption-sized one."""
    side = nodes.withColumn("category", T.region_category(F.col("region_type")))
    me = side.filter("category IN ('table', 'figure')").select(*KEYS, "node_id", "category")
    other = side.filter("category = 'text'").select(*KEYS, F.col("node_id").alias("other"), T.word_count(F.col("text")).alias("n"))
    c = me.join(edges.select(*KEYS, F.col("source").alias("node_id"), F.col("target").alias("other"), "rank"), [*KEYS, "node_id"]).join(other, [*KEYS, "other"])
    fits = ((F.col("category") == "table") & (F.col("n") >= text_words)) | ((F.col("category") == "figure") & F.col("n").between(5, 50))
    best = c.filter(fits).groupBy(*KEYS, "node_id", "category").agg(F.min_by("other", "rank").alias("other"))
    table = F.col("category") == "table"
    return best.select(*KEYS, F.when(table, F.col("other")).otherwise(F.col("node_id")).alias("source"), F.when(table, F.col("node_id")).otherwise(F.col("other")).alias("target"),
                       F.when(table, "text_table_validation").otherwise("figure_caption_mapping").alias("template"))


# --- declared rules -----------------------------------------------------------------------------------------------------------------
# What a usable question and answer must keep to, and what a question must not say.
LEAST_QUESTION_WORDS, MOST_ANSWER_CHARS, LEAST_CONSISTENCY = 5, 500, 0.3
REJECTED = {
    "vague": ("what is this", "describe", "explain", "tell me about"),
    "region_reference": ("region 1", "region 2", "first region", "second region", "in the first region", "in the second region"),
    "trivial": ("what is written in region", "read region", "what does region contain"),
}


def _terms(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def consistency(answer: Column, quotes: Column) -> Column:
    """Share of the answer's distinct words that stand in the quotes; 1 for an answer without words."""
    words = _terms(F.coalesce(answer, F.lit("")))
    return F.when(F.size(words) == 0, 1.0).otherwise(F.size(F.array_intersect(words, _terms(F.coalesce(quotes, F.lit(""))))) / F.size(words))


def quality_flags(df: DataFrame) -> DataFrame:
    """Which declared rules each row keeps: fields there, a quote there, question long enough, answer short enough, answer in the quotes,
    no vague or trivial question and none about regions, which readers can't see. ``kept``: all of them."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    quotes = F.from_json("evidence_quotes", "array<string>")
    low = F.lower(text("question"))
    says = lambda kind: F.exists(F.array(*map(F.lit, REJECTED[kind])), lambda p: F.contains(low, p))
    flags = {
        "has_fields": (strip(text("question")) != "") & (strip(text("answer")) != "") & F.col("evidence_region_ids").isNotNull() & F.col("evidence_quotes").isNotNull() & F.col("reasoning_type").isNotNull(),
        "has_quotes": F.coalesce(F.size(quotes) > 0, F.lit(False)), "long_question": T.word_count(F.col("question")) >= LEAST_QUESTION_WORDS, "short_answer": F.length(text("answer")) <= MOST_ANSWER_CHARS,
        "consistent": consistency(F.col("answer"), F.array_join(quotes, " ")) >= LEAST_CONSISTENCY, **{f"not_{k}": ~says(k) for k in REJECTED},
    }
    df = df.withColumns(flags)
    kept = F.lit(True)
    for k in flags:
        kept = kept & F.col(k)
    return df.withColumn("kept", kept)


_LONG_DATE = r"\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}[/-]\d{1,2}[/-]\d{1,2}|\w+\s+\d{1,2},?\s+\d{4}"
# The questions that each rule template takes.
TEMPLATES = {
    "FORM_001": r"(what is|what's|value of)\s+(the\s+)?([\w\s]+)\?",
    "FORM_002": r"(when|what date|what is the date|which date).*\?",
    "FORM_003": r"(how much|what is the|what's the).*(total|amount|price|cost|quantity|number).*\?",
    "FORM_004": r"(is|was|has).*\?(yes|no|checked|selected)?",
    "TABLE_001": r"(what is|what's|find).*\bfor\b.*|.*\bwhere\b.*",
    "TABLE_002": r"(what are|list|show).*(column|header|field).*",
    "TABLE_003": r"(how many|count|total number).*",
    "TABLE_004": r"(what is|find|what's).*\bwhere\b.*|.*\bwhen\b.*",
    "TEXTBLOCK_001": r"(who|what|which).*(name|company|organization|person|location).*\?",
    "TEXTBLOCK_002": r"(when|what date|which date).*\?",
    "TEXTBLOCK_003": r"(how much|what is the|what amount).*(cost|price|amount|total|fee|charge|payment).*\?",
    "TEXTBLOCK_004": r"(what is the|where|what's the).*(address|location|street|city).*\?",
}
# What the answers of the templates for dates, amounts and addresses must hold.
DETECTORS = {
    "date": _LONG_DATE + r"|\d{1,2}\s+\w+\s+\d{4}",
    "amount": r"\$\s*\d+[,.]?\d*|\d+[,.]\d{2}\s*(USD|EUR|GBP|dollars?|euros?|pounds?)|\d+[,.]\d{2,3}",
    "street": r"\d+\s+[A-Z][a-zA-Z\s]+(?:Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Lane|Ln|Drive|Dr)",
    "zip": r"\b\d{5}(?:-\d{4})?\b",
    "city_state": r"[A-Z][a-zA-Z\s]+,\s*[A-Z]{2}",
    "full_address": r"\d+\s+[A-Z][a-zA-Z\s,]+\d{5}",
}
# Boxes and words for yes and no.
BOOLEANS = {"✓": "yes", "☑": "yes", "checked": "yes", "✗": "no", "☐": "no", "unchecked": "no", "yes": "yes", "no": "no", "true": "yes", "false": "no"}


def matching_templates(question: Column) -> Column:
    """Ids of the rule templates that take the question, in their order."""
    q = F.coalesce(question, F.lit(""))
    return F.filter(F.array(*(F.when(q.rlike("(?i)" + p), k) for k, p in TEMPLATES.items())), lambda x: x.isNotNull())


def detected(answer: Column) -> Column:
    """Which kinds of value an answer holds: date, amount, street, zip, city_state, full_address, in this order."""
    a = F.coalesce(answer, F.lit(""))
    return F.filter(F.array(*(F.when(a.rlike(p), k) for k, p in DETECTORS.items())), lambda x: x.isNotNull())


def boolean_value(answer: Column) -> Column:
    """yes or no for an answer that is nothing but a box or a word for it, else null."""
    a = F.lower(strip(F.coalesce(answer, F.lit(""))))
    return F.element_at(F.create_map(*(F.lit(x) for kv in BOOLEANS.items() for x in kv)), a)


def answer_kind(answer: Column) -> Column:
    """date, amount, address or boolean: the first that an answer holds, else text."""
    found = detected(answer)
    has = lambda *kinds: F.arrays_overlap(found, F.array(*map(F.lit, kinds)))
    return F.when(has("date"), "date").when(has("amount"), "amount").when(has("street", "zip", "city_state", "full_address"), "address").when(boolean_value(answer).isNotNull(), "boolean").otherwise("text")
