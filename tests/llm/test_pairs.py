import pytest

from leafgraph.llm.pairs import defect_of, defective_pairs, tiles

Q = "Which contract did the private office at Jornham charge to the account in February 1961 for extra storage?"
WHOLE = "The office charged the contract to its account."


@pytest.mark.parametrize(
    ("question", "answer", "kind", "defect"),
    [
        (Q, None, None, "empty_answer"),
        (Q, " \n[ ] —", "lookup", "empty_answer"),
        (Q, "I'm sorry, but I cannot tell.", "lookup", "refusal"),
        (Q, "as an assistant it isn’t possible for me to say", "lookup", "refusal"),
        (Q, "Well, no answer can be given by me here. Try another page.", "lookup", "refusal"),
        (Q, "The letter says that the office cannot accept storage after May.", "lookup", None),
        (Q, "Albra Tarngate is sorry that the notice was not able to help.", "lookup", None),
        (Q, 'The stamp reads "I cannot accept this" and stands beside the date.', "lookup", None),
        (Q, Q.upper(), "lookup", "copies_question"),
        (Q, f'You asked: "{Q}"', "lookup", "copies_question"),
        (Q, Q.lower().rstrip("?"), "lookup", "copies_question"),
        ("What is the Room?", "What is the Room? What is the Room?", "lookup", "copies_question"),
        ("What is the Page Count?", "The Page Count is 12.", "lookup", None),
        (Q, "Le comptable a transmis la lettre de mars dans les bureaux.", "lookup", "other_language"),
        (Q, "Комиссия подписала договор в марте.", "lookup", "other_language"),
        (Q, 'The stamp reads "la lettre de mars" and stands beside the date.', "lookup", None),
        ("Qui a signé la lettre ?", "The clerk signed that letter in the office.", "lookup", "other_language"),
        ("Qui a signé la lettre ?", "Le directeur a signé la lettre.", "lookup", None),
        ("What is the Ship To?", "98 Gostton Rue des Aulnes", "lookup", None),
        ("What is the Ship To?", "Direct student with a", "lookup", "truncated_answer"),
        (Q, "The office charged the contract to its account (see the", None, "truncated_answer"),
        (Q, 'The office charged the "open account', None, "truncated_answer"),
        (Q, "The office charged the contract to its account,", None, "truncated_answer"),
        (Q, "The office charged the contract to its acc", None, "truncated_answer"),
        (Q, "The office charged the contract…", None, "truncated_answer"),
        (Q, "```\nvalue", None, "truncated_answer"),
        (Q, "<b>The office charged it.", None, "truncated_answer"),
        (Q, "1. The office charged it.\n2.", None, "truncated_answer"),
        (Q, " ".join(["word"] * 30) + "...", "Comprehension", None),
        (Q, " ".join(["word"] * 29) + "...", "comprehension", "truncated_answer"),
        (Q, " ".join(["word"] * 30) + "...", "lookup", "truncated_answer"),
        (Q, "19 June 1968", "lookup", None),
        (Q, "The New York Times", "lookup", None),
        (Q, "The Old Man and the Sea", "lookup", None),
        (Q, "The Board of Trustees", "lookup", None),
        (Q, "The Ministry of Trade and Industry", "lookup", None),
        (Q, "The Old Man and the", "lookup", "truncated_answer"),
        (Q, "(a) first item; (b) second item", "lookup", None),
        (Q, "We do not ship on Sundays.", "lookup", None),
        (Q, "I am not available on Friday.", "lookup", None),
        (Q, "We don't know.", "lookup", "refusal"),
        (Q, "I'm not able to say.", "lookup", "refusal"),
        (Q, "That request cannot be fulfilled.", "lookup", "refusal"),
        (Q, "Regretfully, answering is impossible without more context.", "lookup", "refusal"),
        (Q, "Answering that question falls outside what this assistant can do.", "lookup", "refusal"),
        (Q, "Il contratto non è stato pagato dalla banca per la consegna.", "lookup", "other_language"),
        (Q, "Het contract werd niet door het kantoor voor de rekening betaald.", "lookup", "other_language"),
        (Q, "Yes.", "validation", None),
        (Q, WHOLE, "comprehension", None),
        (None, WHOLE, None, None),
        ("", "x", None, None),
        (Q, WHOLE * 4000, None, None),
    ],
)
def test_defects(question, answer, kind, defect):
    assert defect_of(question, answer, kind) == defect


def test_tiles_longest_first_and_reused():
    a, q = "x b c d y b c d".split(), "a b c d e".split()
    in_a, in_q = tiles(a, q, 3)
    assert in_a == [False, True, True, True, False, True, True, True] and in_q == [False, True, True, True, False]


def test_on_spark_with_clashing_columns_repeats_and_empty(spark):
    rows = [(1, Q, None, None, "x"), (1, Q, None, None, "x"), (2, Q, WHOLE, None, "y"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "row_no long, question string, answer string, reasoning_type string, defect_type string")
    assert sorted(map(tuple, defective_pairs(df).collect()), key=str) == [(1, "empty_answer"), (1, "empty_answer"), (None, "empty_answer")]
    assert defective_pairs(df.limit(0)).count() == 0
