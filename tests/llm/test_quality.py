import pytest

from leafgraph.llm.quality import document_statistics, gap_columns, hanging_items, indent_period, length_period, not_prose, profile, row_period

PROSE = "The clerk counted every ledger\nnear the old harbor before\nthat winter. Each note was lost\nin the office of the manager."
TABLE = "Item    Cost    Share\nPaper    12    4%\nGlass    7    9%"


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        (PROSE, "prose"),
        ("1. " + PROSE, "prose"),
        ("\n".join(w for w in PROSE.split()), "prose"),
        (TABLE, "table"),
        (TABLE.replace("    ", "\t"), "table"),
        ("| Item | Cost |\n| Paper | 12 |\n| Glass | 7 |", "table"),
        ("Item\nCost\nPaper\n12\nGlass\n7\nTin\n9", "table"),
        ("- red paper\n- old glass, thin\n- 12 tins by door", "list"),
        ("a. The clerk counted it.\nb. Each note was lost.\nc. Our lamp broke.", "list"),
        ("old paper\nthin glass\nred door, tall\n12 tins by door", "list"),
        ("red paper for the office\n    and the store\nold glass that is thin\n    from the harbor\n12 tins by the door\n    near the gate", "list"),
        ("reports of the office\n  for the manager\n  for the clerk\nletters of the store\n  for the manager\n  for the clerk\nnotes of the harbor\n  for the manager\n  for the clerk", "list"),
        ("Name of item  Place of the item\nred paper     on the left shelf\nold glass     by the back door\nthin wire     in the store", "table"),
        ("Clerk\nRoom at the end\nTo be kept in the store\nBoxes\nHall at the top\nTo be sent to the mayor\nPaper\nShed at the sea\nTo be read by the clerk", "table"),
        ("    " + PROSE.replace("\n", "\n").replace("winter. ", "winter.\n    "), "prose"),
        ("The clerk  counted every ledger\nnear the old  harbor before that\nwinter.  Each note was lost in the\noffice of  the manager.", "prose"),
        ("The clerk counted every ledger near\n    the old harbor before that winter. Each note\n    was lost. The manager of the office was there.\n    Then it was found in the store.", "prose"),
        ("bird bird bird bird\ngate gate gate", "junk"),
        ("xzkfx thmkhpn sgmzp\ncmdrtp jtkw cjjbc", "junk"),
        ("nap/YJ947sr+OTMNH11SRJCVUGdb8LyKaLJC4hzKhMGJR9vcx1z", "junk"),
        ("^>~>1``^^~/i`&/~ /1_/;.l'1=~|l}>#i", "junk"),
        ("____________________62\n..............30", "junk"),
        ("€ âa�€ ¶Â© ™¿€ �¶Â ©™¶", "junk"),
    ],
)
def test_kinds(text, kind):
    p = profile(text)
    assert max(("prose", "list", "table", "junk"), key=lambda k: p[k + "_chars"]) == kind


def test_period_of_a_column_table():
    assert row_period([False, True, True] * 4, [6, 2, 2] * 4)[0] == 3


def test_periods_and_columns():
    assert length_period([5, 12, 20] * 4) > 0.9 and length_period([30, 31, 30, 29, 31, 30, 30, 31]) < 0.2 and length_period([5, 12, 20]) == 0.0
    assert indent_period([0, 2, 2, 0, 2, 2, 0]) == 1.0 and indent_period([0, 0, 0, 0]) == 0.0 and indent_period([1] + [0] * 9) == 0.0
    assert gap_columns(["ab  cd", "ef  gh", "x y"]) == [True, True, False] and gap_columns(["a  bcdef", "abcd  e"]) == [False, False]
    assert hanging_items([0, 4, 0, 4], [False, True, False, True]) == 2 and hanging_items([0, 0, 4, 0], [False, True, False, True]) == 0


def test_documents(spark):
    t = "2026-01-0{} 00:00:00"
    rows = [
        (1, "a", 1, 0, PROSE, t.format(1), "x"), (2, "a", 1, 1, TABLE, t.format(1), "x"), (3, "a", 1, 1, None, t.format(2), "x"),
        (4, "b", 1, 0, TABLE, t.format(1), "x"), (5, "b", None, None, "word " * 4, t.format(1), "x"), (6, "c", 1, 0, None, None, "x"), (7, None, 1, 0, TABLE, None, "x"),
        (8, "d", 1, 0, PROSE * 3000, t.format(1), "x"),
    ]
    df = spark.createDataFrame(rows, "region_id long, doc_id string, page_no int, node_id int, text string, created_at string, text_kind string")
    got = {r.doc_id: r for r in document_statistics(df).collect()}
    assert got["a"].text_kind == "prose" and got["a"].table == 0 if "table" in got["a"] else got["a"].text_kind == "prose"
    assert got["b"].text_kind == "table" and got["c"].text_kind is None and got["c"].words == 0 and got["d"].text_kind == "prose"
    assert {tuple(r) for r in not_prose(df).collect()} == {("b", "table"), (None, "table")}
    assert not_prose(df.limit(0)).count() == 0
