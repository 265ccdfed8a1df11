import random

from hypothesis import given, settings
from hypothesis import strategies as st

from leafgraph.llm.leaks import _SENTENCE, Automaton, item_blocks, leak_report, leaked_items, normal_words, without_leaks, word_places

PASSAGE = "The first early clerk counted every long ledger near the old harbor before that cold winter. Each later note was lost."
NOTICE = "This sheet must not leave the reading room today."


def test_words_ignore_forms():
    assert normal_words("Re-\n ceipt, ﬁne — “Year‐end” soft­ware\xad\nhouse") == ["receipt", "fine", "yearend", "softwarehouse"]
    assert normal_words(None) == normal_words("") == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=12), max_size=5), st.lists(st.sampled_from("abcde"), max_size=30), st.integers(1, 4))
def test_automaton_is_brute_force(items, text, least):
    a = Automaton(enumerate(items))
    got = set()
    for end, state, size in a.matches(text):
        assert any(text[end - size + 1 : end + 1] == x[i : i + size] for x in items for i in range(len(x)))
        if size >= least:
            got |= {(end, i) for i in a.items[a.at_length(state, least)]}
    want = {(e, i) for e in range(least - 1, len(text)) for i, x in enumerate(items) if any(x[j : j + least] == text[e - least + 1 : e + 1] for j in range(len(x)))}
    assert got == want


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string, item_id long"), spark.createDataFrame(items, "item_id long, passage string, doc_id long")


def test_found_and_removed(spark):
    cut = PASSAGE.split()
    docs = [(1, "Before. " + PASSAGE.upper().replace(" EARLY", "\n EARLY") + " After it all.", 0), (2, " ".join(cut[:11]) + " else", 0), (3, " ".join(cut[2:14]), 0), (4, NOTICE + " " + NOTICE, 0), (5, None, 0), (6, "", 0), (1, "nothing", 0)]
    items = [(7, NOTICE + " " + PASSAGE, 0), (8, "Other words. " + NOTICE, 0), (9, NOTICE, 0), (10, None, 0), (11, PASSAGE, 0)]
    d, i = frames(spark, docs, items)
    got = {(r.doc_id, r.item_id) for r in leaked_items(d, i).collect()}
    assert got == {(1, 7), (1, 11), (3, 7), (3, 11)}
    assert {(r.doc_id, r.item_id) for r in leaked_items(d, i, block_words=10).collect()} == got
    assert leaked_items(d, i.limit(0)).count() == leaked_items(d.limit(0), i).count() == 0
    left = {(r.doc_id, r.spans_removed): r.text for r in without_leaks(d, i, most_covered=0.95).collect()}
    assert left[1, 1] == "Before. . After it all." and (3, 1) not in left and left[5, 0] is None
    assert {(r.doc_id, r.spans_removed): r.text for r in without_leaks(d, i, most_covered=0.95, block_words=10).collect()} == left
    report = {r.doc_id: (r.spans_removed, r.kept) for r in leak_report(d, i, most_covered=0.95).collect()}
    assert report == {1: (1, True), 3: (1, False)}


def test_sentences_begin_with_any_capital():
    assert len(_SENTENCE.split("Ça va bien, mes amis. Été comme hiver. Ключ здесь! 12 notes. and so on")) == 4
    notice = "Été comme hiver cette salle reste ouverte."
    rows = [(k, f"Ça va bien, mes amis. {notice}") for k in range(3)]
    assert not [w for block in item_blocks(rows, 100) for _, runs in block for r in runs for w in r if w == "hiver"]


def test_blocks_hold_every_item():
    rows = [(i, " ".join(random.choices("pqrs", k=9))) for i in range(20)]
    blocks = item_blocks(rows, 20)
    assert [i for b in blocks for i, _ in b] == list(range(20)) and len(blocks) > 5


def test_places_agree_with_words():
    t = "Re-\nceipt of soft­\nware, year-end No. 5"
    assert len(word_places(t)) == len(normal_words(t))
