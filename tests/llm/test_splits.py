import random

from hypothesis import given, settings
from hypothesis import strategies as st

from leafgraph.llm.splits import banded_distance, found_pairs, overlap_report, overlapping_questions
from leafgraph.llm.words import WORD

SCHEMA = "qa_id string, doc_id string, split string, question string, source string, cls string, key string"


def brute(rows, share=0.7, least=12):
    sets = [(i, d, (s or "").strip().lower(), frozenset(WORD.findall((q or "").lower()))) for i, d, s, q, *_ in rows]
    out = set()
    for i, d, s, a in sets:
        for j, e, t, b in sets:
            if s == "train" and t in ("val", "validation", "test") and a and b and i and j and i != j and len(a & b) / len(a | b) >= share - 1e-12:
                if (d == e and d is not None) or min(len(a), len(b)) >= least:
                    out.add((min(i, j), max(i, j)))
    return out


def test_pairs_are_brute_force(spark):
    rng = random.Random(5)
    common, rare = "the of and to in for on with by at".split(), [f"w{i}" for i in range(60)]
    base = [rng.sample(common, 6) + rng.sample(rare, rng.randint(1, 14)) for _ in range(25)]
    rows = []
    for i in range(260):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(rare)
        rng.shuffle(words)
        rows.append((f"d{i % 7}_{i}", f"d{i % 7}" if i % 11 else None, rng.choice(["train", " Train", "val", "TEST", "validation", None, "x"]), " ".join(words) + "?", "s", "c", "k"))
    rows += [("x1_0", "d1", "train", "What is the room?", "s", "c", "k"), ("x1_1", "d1", "val", "what is the Room", "s", "c", "k"), ("x2_9", "d2", "val", "What is the room?", "s", "c", "k")]
    rows += [(None, "d1", "val", "What is the room?", "s", "c", "k"), ("n1", "d1", "val", None, "s", "c", "k"), ("n2", "d1", "val", "", "s", "c", "k"), ("n3", "d1", "val", "word " * 90000, "s", "c", "k")]
    rows += rows[:40]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert want and {tuple(r) for r in found_pairs(df).collect()} == want
    for few, hot in ((4.0, 4.0), (1e-6, 0.01)):  # pieces of many words
        assert {tuple(r) for r in found_pairs(df, few=few, hot=hot).collect()} == want
    report = overlap_report(df).collect()
    assert sum(r.pairs for r in report) == len(want) and {r.source for r in report} == {"s"}
    # Ids of several questions, and ids on both sides: each pair still counts once.
    odd = rows + [(i, d, s, rows[(k * 7) % 200][3], *r) for k, (i, d, s, q, *r) in enumerate(rows[:60])] + [(rows[3][0], "d1", "train", rows[5][3], "s", "c", "k"), (rows[3][0], "d1", "test", rows[5][3], "s", "c", "k")]
    df2 = spark.createDataFrame(odd, SCHEMA)
    want2 = {tuple(r) for r in overlapping_questions(df2).collect()}
    assert {(min(p), max(p)) for p in want2} == brute(odd)
    splits = {}
    for i, d, s, *_ in odd:
        if s and s.strip().lower() in ("val", "validation", "test"):
            splits.setdefault(i, set()).add("test" if s.strip().lower() == "test" else "validation")
    assert sum(r.pairs for r in overlap_report(df2).collect()) == sum(len(splits[e]) for _, e in want2)
    assert found_pairs(df.limit(0)).count() == 0 and found_pairs(df.filter("trim(lower(split)) = 'train'")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=9), st.lists(st.sampled_from("abcde"), max_size=9), st.integers(0, 12))
def test_banded_distance(a, b, most):
    full = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            full[i][j] = i + j if not i or not j else min(full[i - 1][j] + 1, full[i][j - 1] + 1, full[i - 1][j - 1] if a[i - 1] == b[j - 1] else 99)
    d = full[-1][-1]
    assert banded_distance(a, b, most) == (d if d <= most else None)


def test_hot_document_and_growth(spark):
    """All short questions in one document, few words: pieces grow, and nothing is lost."""
    rng = random.Random(9)
    words = "the what is for of room date name page total line item sum box".split()
    rows = [(f"h_{i}", "hot", rng.choice(["train", "val"]), " ".join(rng.sample(words, rng.randint(1, 9))), "s", "c", "k") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert len(want) > 500
    for few, hot in ((0.25, 20.0), (1e-6, 0.1)):
        assert {tuple(r) for r in found_pairs(df, few=few, hot=hot).collect()} == want
