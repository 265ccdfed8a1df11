import pytest
from pyspark.sql import functions as F

from leafgraph.config import NormConfig
from leafgraph.functions import textnorm as N
from leafgraph.functions import tokens as T
from leafgraph.operators import qa as Q

ALL = NormConfig(remove_punctuation=True, normalize_numbers=True, remove_accents=True)


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", fn(F.col("t")).alias("x")).orderBy("i").collect()]


def test_normaliser(spark):
    cases = {"Invoice Number: INV-2024-001": "1nvoice number 1nv-2024-001", "Total: $1,234.56 (10% tax)": "tota1 1234 56 10 tax", "Date: O3/15/2O24": "date 03 15 2024", "Amount: 1.5K": "amount 1500", "Café résumé": "cafe resume", None: "", "": ""}
    assert column(spark, list(cases), lambda c: N.normalize(c, ALL)) == list(cases.values())
    assert column(spark, ["HELLO", "hell0", " a \t b "], N.normalize) == ["hell0", "he110", "a b"]

    assert N.expand_abbreviations("2M and 1.2.3K, 3 kb") == "2000000 and 1.2.3K, 3 kb"


def test_similarity(spark):
    df = spark.createDataFrame([("INV-2024-001", "Invoice Number: INV-2024-001"), ("$1,234.56", "1234.56"), ("March 15, 2024", "03/15/2024"), ("", ""), ("a", "")], "a string, b string")
    got = [r.s for r in df.select(N.similarity(F.col("a"), F.col("b"), ALL).alias("s")).collect()]
    assert got == pytest.approx([1 / 3, 1.0, 0.5, 1.0, 0.0])


def test_answer_span(spark):
    rows = [("red door", "the red door fell"), ("red old door", "the red door old fell"), ("nothing here", "the red door"), ("", "abc")]
    df = spark.createDataFrame(rows, "a string, c string").select(N.answer_span(F.col("a"), F.col("c")).alias("s"))
    assert [tuple(r.s) for r in df.collect()] == [(4, 12, 1.0), (4, 16, 1.0), (-1, -1, 0.0), (0, 0, 1.0)]


def test_token_types(spark):
    cases = {"": "empty", "8:30 a.m": "time", "Room 8:30": "time", "12/15/2023": "date", "5 Mar 2024": "date", "March 15, 2024": "date", "Name:": "form_key", "date": "form_key", "Invoice Date : x": "form_key", "ABC12345": "code", "1234-ABC": "code", "12345678": "code", "1,234.50": "number", "42": "number", "$ 5": "number", "hello": "text", None: "empty"}
    assert column(spark, list(cases), T.token_type) == list(cases.values())


def test_values_follow_keys(spark):
    rows = [(1, i, t, 10.0 * i, 0.0, 10.0 * i + 8, 16.0) for i, t in enumerate(["Name:", "Date:", "Total:", "hello", "x"])] + [(2, 0, "Name:", 0.0, 0.0, 8.0, 16.0), (2, 1, "far", 900.0, 0.0, 950.0, 16.0), (3, 0, "Name:", None, 0.0, 8.0, 16.0), (3, 1, "x", 0.0, 0.0, 8.0, 16.0)]
    df = spark.createDataFrame(rows, "d int, token_id int, text string, xmin double, ymin double, xmax double, ymax double")
    got = [r.token_type for r in T.classify_tokens(df, ["d"]).orderBy("d", "token_id").collect()]
    assert got == ["form_key", "form_value", "form_key", "form_value", "text", "form_key", "text", "form_key", "text"]


def test_categories_and_lines(spark):
    assert column(spark, ["Table", "my_table", "Chart", "figures", None, "TextBlock", "formula"], T.region_category) == ["table", "table", "figure", "figure", "text", "text", "form"]
    assert column(spark, ["Name: John", "8:30 am: x", "This is a very long sentence that has too many words: x", "No colon"], lambda c: T.form_line(c)["value"]) == ["John", None, None, None]


def test_form_fields(spark):
    cases = [
        ("Name: John Date: Monday", [("Name", "John"), ("Date", "Monday")]), ("Invoice Number: INV-001 Amount: $500", [("Invoice Number", "INV-001"), ("Amount", "$500")]),
        ("Name: John Smith\nDate: 2024-01-15\nAddress: 123 Main St", [("Name", "John Smith"), ("Date", "2024-01-15"), ("Address", "123 Main St")]), ("This is a sentence: another sentence", []),
        ("Company: ABC Corp Contact: Mr. X Phone: 123-456", [("Company", "ABC Corp"), ("Contact", "Mr."), ("X Phone", "123-456")]), ("It is important: to note this", []), ("Total: $1,500.00", [("Total", "$1,500.00")]), (None, []),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, text string")
    got = Q.form_fields(df, "i").orderBy("i", "line", "field").collect()
    assert [(r.i, r.key, r.value) for r in got] == [(i, k, v) for i, (_, fs) in enumerate(cases) for k, v in fs]


def test_table_rows(spark):
    cases = ["| A | B |", "A\tB", "Item one   12", "Total cost 1,234", "Price 12", "", "one two three"]
    assert column(spark, cases, Q.split_row) == [["A", "B"], ["A", "B"], ["Item one", "12"], ["Total cost", "1,234"], ["Price 12"], [], ["one two three"]]
    assert column(spark, ["| A | B |\n\n| x | 1 |\nlone"], Q.parse_table) == [[["A", "B"], ["x", "1"]]]


def test_json_in_replies(spark):
    cases = ['x ```json\n{"a": "1"}\n``` y', '{"a": "2"}', 'so {"a": "3"} it is', "none", None, '```json\n{bad}\n``` {"a": "4"}']
    assert column(spark, cases, lambda c: Q.json_in_text(c)["a"])[:5] == ["1", "2", "3", None, None]


NODE = "doc_id string, page_no int, node_id int, region_type string, xmin double, ymin double, xmax double, ymax double, score double, text string, is_short boolean"


def test_generated_questions(spark):
    nodes = spark.createDataFrame(
        [
            ("d", 1, 0, "text", 0.0, 0.0, 10.0, 10.0, 1.0, "Table 1: sales", True), ("d", 1, 1, "table", 0.0, 20.0, 10.0, 40.0, 1.0, "| Item | Cost |\n| tin | 5 |", False),
            ("d", 1, 2, "form", 0.0, 50.0, 10.0, 60.0, 1.0, "Name: John", False), ("d", 1, 3, "figure", 0.0, 70.0, 10.0, 80.0, 1.0, "a chart", False),
            ("d", 1, 4, "text", 0.0, 90.0, 10.0, 99.0, 1.0, "word " * 31, False), ("e", 1, 0, "form", 0.0, 0.0, 1.0, 1.0, 1.0, None, False),
        ], NODE)
    edges = spark.createDataFrame([("d", 1, 1, 0, "below", 0.9, "spatial", 1)], "doc_id string, page_no int, source int, target int, relation string, score double, category string, rank int")
    got = Q.generate_qas(nodes, edges).orderBy("idx").collect()
    assert [(r.question, r.answer) for r in got] == [
        ("What are the column headers in the table?", "Item, Cost"), ("How many data rows are in the table (excluding the header)?", "1"), ("What is the Cost for tin?", "5"), ("What is the Name?", "John"),
        ("What does the figure show?", "a chart"), ("What information does 'Table 1: sales' present?", "The table shows data with columns: Item, Cost. It contains 1 data rows."),
        ("What is the main topic or content discussed in this section?", " ".join(["word"] * 30) + "..."),
    ]
    again = Q.first_questions(Q.generate_qas(nodes, edges).drop("idx"), ["doc_id"], ["node_id"])
    assert again.count() == len(got) and {r.qa_id for r in Q.csv_rows(Q.generate_qas(nodes, edges), F.lit("train")).collect()} == {f"d_1_{i}" for i in range(7)}
    assert Q.generate_qas(nodes.limit(0), edges.limit(0)).count() == 0


def test_labels_begin_at_any_capital():
    assert Q.fields_of_line("Tên: an Địa chỉ: hanoi Ngày: mai") == [("Tên", "an"), ("Địa chỉ", "hanoi"), ("Ngày", "mai")]
    assert Q.fields_of_line("Имя: анна Город: Рим") == [("Имя", "анна"), ("Город", "Рим")]
    assert Q.fields_of_line("Name: Anna Bell Room: 12") == [("Name", "Anna Bell"), ("Room", "12")]
