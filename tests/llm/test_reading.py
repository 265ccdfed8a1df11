import random

import numpy as np

from leafgraph.llm.reading import Scale, cut_points, english_prose, reading_levels

BANDS = [["cat", "dog", "sun", "map", "bed", "cup"], ["garden", "window", "letter", "market", "driver"], ["department", "inventory", "commission", "regulation"], ["heterogeneity", "multicollinearity", "epistemology", "thermodynamics"]]


def text(level, rng, n=110):
    names = BANDS[level - 1] + (BANDS[level - 2][:2] if level > 1 else [])
    return " ".join(rng.choice(["the", "of", "that", "was", "each"]) if i % 2 else rng.choice(names) for i in range(n)) + "."


def test_levels_of_unlabelled_documents(spark):
    rng = random.Random(4)
    docs = [(i, text(i % 4 + 1, rng), "x") for i in range(120)]
    extra = [(900, None, "x"), (901, "", "x"), (902, "the cat. " * 5, "x"), (903, "le chat de la maison et une table pour les amis dans la rue " * 12, "x"), (904, text(2, rng, 9000), "x"), (1, docs[1][1], "x")]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string, reading_level string")
    labels = spark.createDataFrame([(i, i % 4 + 1) for i in range(12)] + [(900, 1), (None, 2), (3, None)], "doc_id long, reading_level int")
    got = [tuple(r)[:2] for r in reading_levels(df, labels).collect()]
    assert sum(i == 1 for i, _ in got) == 2 and {i for i, _ in got} == set(range(120)) | {904}
    assert np.mean([level == (2 if i == 904 else i % 4 + 1) for i, level in got]) == 1.0
    assert reading_levels(df, labels.limit(0)).count() == 0 and reading_levels(df.limit(0), labels).count() == 0


def test_mainly_english_prose():
    rng = random.Random(1)
    prose = text(2, rng)
    assert english_prose(prose) and english_prose(prose.upper()) and not english_prose(prose[:200])
    assert not english_prose("- red paper\n" * 200 + "\n" + prose)


def test_cuts_lie_between_grades():
    cuts = cut_points(np.array([1.0, 1.2, 2.0, 2.4]), np.array([1, 1, 3, 3]))
    assert cuts == [(1, -np.inf), (3, 1.6)]


def test_words_step_finds_the_curves():
    """Sums that are what the model expects at known curves are at the maximum: the words step leads back to them."""
    rng = np.random.default_rng(3)
    truth = Scale(6, 0.0, 5.0)
    slots = np.arange(6)
    truth.a[:], truth.b[:], truth.c[:] = rng.normal(-1, 1, 6), rng.normal(0, 0.5, 6), rng.uniform(0.1, 0.6, 6)
    truth._normalize(slots)
    words_at = rng.uniform(100, 1000, len(truth.grid))
    expected = np.exp(truth.a[:, None] + truth.b[:, None] * truth.grid - truth.c[:, None] * truth.grid**2 - truth.log_z) * words_at
    n, s1, s2 = (expected @ (truth.grid**k) for k in range(3))
    scale = Scale(6, 0.0, 5.0)
    for _ in range(20):
        scale.learn(slots, n, s1, s2, words_at, 1e-9)
    curve = lambda s: s.a[:, None] + s.b[:, None] * s.grid - s.c[:, None] * s.grid**2 - s.log_z
    assert np.abs(curve(scale) - curve(truth)).max() < 0.05


def test_documents_step_finds_the_level():
    scale = Scale(40, 0.0, 5.0)
    scale.a[:], scale.b[:], scale.c[:] = -3.0, np.linspace(-4, 4, 40), 1.0  # tops from -2 to 2 around the middle
    scale._normalize(np.arange(40))
    values = np.concatenate([np.flatnonzero(np.abs(np.linspace(-2, 2, 40) - m) < 0.5) for m in (-1.0, 0.0, 1.0)])
    counts = [int((np.abs(np.linspace(-2, 2, 40) - m) < 0.5).sum()) for m in (-1.0, 0.0, 1.0)]
    own, _, n = scale.own_levels(values, np.concatenate(([0], np.cumsum(counts))))
    fine = np.linspace(scale.grid[0], scale.grid[-1], 4001)
    curves = scale.a[:, None] + scale.b[:, None] * fine - scale.c[:, None] * fine**2
    logs = curves - np.log(np.exp(curves).sum(0))
    for k, part in enumerate(np.split(values, np.cumsum(counts)[:-1])):
        assert abs(own[k] - 2.5 - fine[logs[part].sum(0).argmax()]) < 0.01
    assert np.all(np.diff(own) > 0.3) and n.tolist() == counts
