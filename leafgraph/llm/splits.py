"""Questions of evaluation splits that also stand, the same or nearly so, in the training split (problem 4).

Two questions overlap if they share at least ``share`` of all their distinct words (Jaccard). The method is the edit-distance segment
join, on words for letters: a question becomes the string of its distinct words in one global order, rare words first. Between two such
strings the distance by insertions and deletions is the size of the symmetric difference, so the bound on the Jaccard value is a bound k
on the distance that depends on the lengths only. A question of n words that may miss d words of a partner is cut after its first d + 1
words: of these d + 1 segments one survives in the partner, within the partner's own first words (the allowed positions). Where the
surviving word is frequent, the next survivor is joined to it, found one position further at most, then the next, until at most ``few``
partners are to be expected of the words together. Both sides decide that from the same counts, so the join stays complete, and a
question's candidates stay few however large the corpus is. (Even segments of neighbouring words lie in the frequent words, too, and
there their candidates grow with the square of the corpus; the README has figures.)

Where words alone lead to more than ``hot`` partners the longer piece is the key by which rows are shuffled; between ``few`` and ``hot``
the row carries the longer pieces as short hashes, and the shuffled rows are split by them inside the task. Candidates whose 64-bit word
maps differ in more than k bits are dropped there (each differing bit proves a differing word); the rest are verified by banded dynamic
programming of width k.

Counts are kept in a sketch of 2^20 slots by hash: words (and documents) that share a slot are taken for more frequent than they are,
which costs longer pieces and loses nothing. The two sketches and the shortest length on each side are all that is gathered at the
driver, whatever the corpus. Everything else is shuffled by hashes of pieces or classes, which spread.

Questions of twelve or more words are joined over the whole corpus, shorter ones (and those they can reach) within their document, with
the document's size in place of the corpus's: in a document that holds a third of all rows the pieces grow as they do in the corpus.
Equal word strings are one class on each side: a question copied a million times is one class; pairs are made at the end, from members.

Defined results for odd input: null or wordless questions, null ids and rows of no split (null or unknown) pair with nothing; splits may be
written with any case and blanks, ``val`` is validation; rows delivered again share their id, and each pair of ids comes out once; an id on
both sides may pair with another id, not with itself; a null document id equals no other; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.batches import map_columns
from leafgraph.llm.words import WORD
from leafgraph.sources.tables import written

TRAIN, EVAL = 0, 1
SLOTS = 1 << 20  # of the sketches of counts
_DEPTH = 8  # most words of a piece
#: Keys have 48 bits, so that a short hash can stand behind them; chance matches are dropped like other candidates.
_KEY_BITS = np.uint64((1 << 48) - 1)
_HEAD, _LONG = 5, 0xFFFF  # units before the short hashes; numbers of words are kept up to there
_MULTIPLIER, _CAPPED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x165667B19E3779F9)


def split_name(col: Column) -> Column:
    """train, validation or test, else null."""
    s = F.lower(F.regexp_replace(col, r"(?U)^\s+|\s+$", ""))
    return F.when(s.isin("val", "valid", "validation", "dev"), "validation").when(s.isin("train", "training"), "train").when(s == "test", "test")


def least_overlap(a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    """Fewest common words of sets of a and b words whose Jaccard value reaches the share."""
    return np.ceil(share / (1 + share) * (np.asarray(a, float) + b) - 1e-9).astype(np.int64)


def banded_distance(a: list, b: list, most: int) -> int | None:
    """Insertions and deletions that turn a into b, if at most ``most``; dynamic programming over the diagonals within the bound."""
    if abs(len(a) - len(b)) > most:
        return None
    big = most + 1
    row = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        nxt: dict[int, int] = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            best = row.get(j, big) + 1
            if j:
                best = min(best, nxt.get(j - 1, big) + 1)
                if b[j - 1] == x:
                    best = min(best, row.get(j - 1, big))
            nxt[j] = best
        row = nxt
        if min(row.values()) > most:
            return None
    d = row.get(len(b), big)
    return d if d <= most else None


def _records(df: DataFrame, record_id: str, doc_id: str, split: str, question: str) -> DataFrame:
    """Id, document, side, distinct words in alphabetical order (parted by blanks), their number and their 64-bit map."""
    side = F.when(split_name(F.col(split)) == "train", TRAIN).when(split_name(F.col(split)).isNotNull(), EVAL)
    rows = df.select(F.col(record_id).cast("string").alias("i"), F.col(doc_id).cast("string").alias("d"), side.alias("s"), F.col(question).alias("q")).filter("i IS NOT NULL AND s IS NOT NULL AND q IS NOT NULL")

    def make():
        def run(ids, docs, sides, questions):
            out = ([], [], [], [], [], [])
            for i, d, s, q in zip(ids, docs, sides, questions):
                words = set(WORD.findall(q.lower()))
                if words:
                    bits = 0
                    for w in words:
                        bits |= 1 << (zlib.crc32(w.encode()) >> 26)
                    for c, v in zip(out, (i, d, s, " ".join(sorted(words)), len(words), bits - (1 << 64) if bits >> 63 else bits)):
                        c.append(v)
            return dict(zip(("id", "doc", "side", "words", "n", "map"), out))

        return run

    return map_columns(rows, {c: F.col(c) for c in "idsq"}, make, "id string, doc string, side int, words string, n int, map long")


def _sketch(values: DataFrame, column: str) -> np.ndarray:
    """How often the values of each slot occur; one number a slot, whatever the input."""
    got = values.groupBy(F.pmod(F.crc32(column), F.lit(SLOTS)).cast("int").alias("slot")).agg(F.count("*").alias("c")).toArrow()
    counts = np.zeros(SLOTS, np.float32)
    counts[got.column("slot").to_numpy()] = got.column("c").to_numpy()
    return counts


def _slot(value: str) -> int:
    return zlib.crc32(value.encode()) & (SLOTS - 1)


def _mixed(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    x = (h ^ more) * _MULTIPLIER
    return x ^ (x >> np.uint64(31))


def segment_keys(hashes: np.ndarray, shares: np.ndarray, starts: np.ndarray, missing: np.ndarray, seeds: np.ndarray, partners: np.ndarray, ends: np.ndarray, few: float, hot: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of each question that may survive in a partner: (question, key, short hash of the longer piece or -1).

    ``hashes`` and ``shares`` (of all questions) are those of the words in order, question by question from ``starts``; ``partners`` are
    expected before any word is known. ``ends[k]`` says for each number of words at which lengths a piece ends whatever is expected: its
    last end is that of the question itself, earlier ones are those of shorter partners, which can't go further."""
    n = np.diff(starts)
    own_end = ends.shape[1] - 1 - np.argmax(ends[:, ::-1], axis=1)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def short(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(48)).astype(np.int32)

    def grow(rows: np.ndarray, h: np.ndarray, e: np.ndarray, key: np.ndarray, j: int, size: int) -> None:
        while len(rows):
            keep = (j < n[rows]) & (j <= missing[rows] + size)
            if not keep.all():
                rows, h, e, key = rows[keep], h[keep], e[keep], key[keep]
                if not len(rows):
                    return
            at = starts[rows] + j
            e2, h2 = e * shares[at], _mixed(h, hashes[at])
            fresh = (key == 0) & (e2 <= hot)
            key2 = np.where(fresh, h2, key)
            done = e2 <= few
            out.append((rows[done], key2[done], np.where(fresh[done], -1, short(h2[done]))))
            end = ~done & ends[rows, size + 1]
            if end.any():
                h3, k3 = h2[end] ^ _CAPPED, key2[end]
                out.append((rows[end], np.where(k3 == 0, h3, k3), np.where(k3 == 0, -1, short(h3))))
            more = ~done & (size + 1 < own_end[rows])
            grow(rows[more], h2[more], e2[more], key2[more], j + 1, size + 1)
            j += 1

    grow(np.arange(len(n)), seeds, partners, np.zeros(len(n), np.uint64), 0, 0)
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int32)
    rows, keys, tails = (np.concatenate(x) for x in zip(*out))
    return rows, (keys ^ keys >> np.uint64(29)) & _KEY_BITS, tails


def piece_ends(lengths: np.ndarray, share: float, least: int, depth: int) -> np.ndarray:
    """For each number of words, the sizes (0 to ``depth``) at which its pieces may have to end; ``least``: words of the shortest question."""
    out = np.zeros((len(lengths), depth + 1), bool)
    for k, n in enumerate(lengths.tolist()):
        for m in range(max(least, int(np.ceil(share * n - 1e-9))), n + 1):  # shorter partners, and those of its own length
            out[k, min(depth, int(np.ceil(share * m - 1e-9)))] = True
    return out


def _keyed(classes: DataFrame, side: int, counts: np.ndarray, sizes: np.ndarray | None, questions: int, shortest: int, share: float, least: int, few: float, hot: float) -> DataFrame:
    """Rows (key, no, data) of one side's classes. The last bit of ``no`` is the side; ``data`` holds the class's map, its number of words and the
    short hashes of the longer pieces, in units of two bytes."""
    depth = min(_DEPTH, int(least_overlap(least, least, share)) if sizes is None else _DEPTH)
    shared = classes.sparkSession.sparkContext.broadcast((counts, sizes))

    def run(batches):
        counts, sizes = shared.value
        cache: dict[str, tuple[float, int]] = {}

        def known(w: str) -> tuple[float, int]:
            v = (float(counts[_slot(w)]), xxhash.xxh3_64_intdigest(w))
            if len(cache) < 1 << 18:
                cache[w] = v
            return v

        for batch in batches:
            cls, words, scopes = (batch.column(k).to_pylist() for k in range(3))
            maps = batch.column(3).to_numpy()
            if not cls:
                continue
            items = [x for t in words for x in sorted((cache.get(w) or known(w)) for w in t.split(" "))]
            n = np.fromiter((t.count(" ") + 1 for t in words), np.int64, len(cls))
            starts = np.concatenate(([0], np.cumsum(n)))
            shares = np.fromiter((x[0] for x in items), np.float64, len(items)) / questions
            hashes = np.fromiter((x[1] for x in items), np.uint64, len(items))
            partner = np.maximum(np.ceil(share * n - 1e-9).astype(np.int64), shortest)
            missing = n - least_overlap(n, partner, share)  # most words that a partner may lack
            lengths, which = np.unique(n, return_inverse=True)
            ends = piece_ends(lengths, share, least, depth)[which]
            seeds = np.array([xxhash.xxh3_64_intdigest(s) if s else 1 for s in scopes], np.uint64)
            partners = np.full(len(n), float(questions)) if sizes is None else np.array([sizes[_slot(s)] for s in scopes], np.float64)
            rows, keys, tails = segment_keys(hashes, shares, starts, missing, seeds, partners, ends, few, hot)
            order = np.lexsort((keys, rows))
            rows, keys, tails = rows[order], keys[order], tails[order]
            first = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])))) if len(rows) else np.empty(0, np.int64)
            own = rows[first]
            has = tails >= 0
            before = np.concatenate(([0], np.cumsum(has)))
            at = np.concatenate((before[first], before[-1:])) + _HEAD * np.arange(len(first) + 1)
            units = np.empty(int(at[-1]), np.uint16)
            head = at[:-1, None] + np.arange(_HEAD)
            units[head] = np.column_stack((maps[own].view(np.uint16).reshape(-1, 4), np.minimum(n[own], _LONG)))
            rest = np.ones(len(units), bool)
            rest[head] = False
            units[rest] = tails[has]
            data = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((at * 2).astype(np.int32)), pa.py_buffer(units)])
            no = np.array(cls, np.int64)[own] << 1 | side
            yield pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(no), data], ["key", "no", "data"])

    return classes.filter(F.col("side") == side).select("no", "words", "scope", "map").mapInArrow(run, "key long, no long, data binary")


def _partners(keys: np.ndarray, nos: np.ndarray, maps: np.ndarray, ns: np.ndarray, share: float, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Pairs of rows of both sides with equal keys whose lengths and maps allow the share; looked at in pieces of about ``most``."""
    sides = nos & 1
    order = np.lexsort((sides, keys))
    keys, nos, maps, ns, sides = keys[order], nos[order] >> 1, maps[order], ns[order], sides[order]
    head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.concatenate((head, [len(keys)])))
    trains = size - np.add.reduceat(sides, head)  # they stand first
    mine = np.flatnonzero(sides == EVAL)
    group = np.searchsorted(head, mine, side="right") - 1
    times = trains[group]
    upto = np.cumsum(times)
    lo = 0
    while lo < len(mine):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, side="right")))
        t = times[lo:hi]
        e = np.repeat(mine[lo:hi], t)
        at = np.arange(len(e)) - np.repeat(np.cumsum(t) - t, t) + np.repeat(head[group[lo:hi]], t)
        far = ns[e] + ns[at] - 2 * least_overlap(ns[e], ns[at], share)  # most words in which they may differ
        near = (np.maximum(ns[e], ns[at]) >= _LONG) | ((np.abs(ns[e] - ns[at]) <= far) & (np.bitwise_count(maps[e] ^ maps[at]) <= far))
        if near.any():
            pairs = np.unique(np.stack((nos[e[near]], nos[at[near]]), 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], ["e", "t"])
        lo = hi


def _matcher(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Candidates (e, t) of rows sorted by key. Rows wait for the end of their key, which ``hot`` bounds."""
        wait: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = []

        def matched() -> Iterator[pa.RecordBatch]:
            keys, nos = (np.concatenate([w[k] for w in wait]) for k in (0, 1))
            counts = np.concatenate([w[2][0] for w in wait])
            units = np.concatenate([w[2][1] for w in wait])
            at = np.concatenate(([0], np.cumsum(counts)))[:-1]
            head = units[at[:, None] + np.arange(_HEAD)]
            rest = np.ones(len(units), bool)
            rest[at[:, None] + np.arange(_HEAD)] = False
            maps = np.ascontiguousarray(head[:, :4]).view(np.uint64)[:, 0]
            each = np.maximum(counts - _HEAD, 1)
            tails = np.zeros(int(each.sum()), np.uint64)
            tails[np.repeat(counts > _HEAD, each)] = units[rest]
            yield from _partners(np.repeat(keys.view(np.uint64) << np.uint64(16), each) | tails, *(np.repeat(x, each) for x in (nos, maps, head[:, 4].astype(np.int64))), share)

        def part(keys, nos, counts, units, lo, hi):
            upto = np.concatenate(([0], np.cumsum(counts)))
            return keys[lo:hi], nos[lo:hi], [counts[lo:hi], units[upto[lo] : upto[hi]]]

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, nos = (batch.column(k).to_numpy() for k in range(2))
            data = batch.column(2)
            offsets = np.frombuffer(data.buffers()[1], np.int32, batch.num_rows + 1, data.offset * 4) // 2
            counts = np.diff(offsets).astype(np.int64)
            units = np.frombuffer(data.buffers()[2], np.uint16)[offsets[0] : offsets[-1]]
            cut = int(np.searchsorted(keys, keys[-1]))  # the batch's last key may go on
            if cut or (wait and wait[-1][0][-1] != keys[0]):
                wait.append(part(keys, nos, counts, units, 0, cut))
                yield from matched()
                wait.clear()
            wait.append(part(keys, nos, counts, units, cut, len(keys)))
        if wait:
            yield from matched()

    return run


def _verified(pairs: DataFrame, share: float) -> DataFrame:
    def make():
        def run(ea, ta, ew, tw):
            keep = ([], [])
            for a, b, x, y in zip(ea, ta, ew, tw):
                p, q = x.split(" "), y.split(" ")
                most = len(p) + len(q) - 2 * int(least_overlap(len(p), len(q), share))
                if banded_distance(p, q, most) is not None:
                    keep[0].append(a)
                    keep[1].append(b)
            return dict(zip(("e", "t"), keep))

        return run

    return map_columns(pairs, {c: F.col(c) for c in ("e", "t", "ew", "tw")}, make, "e long, t long")


def candidates(classes: DataFrame, scoped: bool, share: float, least: int, few: float, hot: float) -> DataFrame | None:
    """Numbers (e, t) of classes that may overlap, some of them several times; None if a side is empty."""
    low = {r.side: (r.n, r.c) for r in classes.groupBy("side").agg(F.min("n").alias("n"), F.count("*").alias("c")).collect()}
    if len(low) < 2:
        return None
    questions = sum(c for _, c in low.values())
    counts = _sketch(classes.select(F.explode(F.split("words", " ")).alias("w")), "w")
    sizes = _sketch(classes, "scope") if scoped else None
    t, e = (_keyed(classes, s, counts, sizes, questions, low[1 - s][0], share, min(x for x, _ in low.values()) if scoped else least, few, hot) for s in (TRAIN, EVAL))
    return t.unionByName(e).repartition("key").sortWithinPartitions("key").mapInArrow(_matcher(share), "e long, t long")


def _class_pairs(classes: DataFrame, scoped: bool, share: float, least_words: int, few: float, hot: float) -> DataFrame | None:
    """Classes of both sides that overlap: (e, t)."""
    found = candidates(classes, scoped, share, least_words, few, hot)
    if found is None:
        return None
    near = written(found.distinct(), "candidates")  # far fewer than the classes, which a join by size can make use of
    for s, x in ((EVAL, "e"), (TRAIN, "t")):
        near = near.join(classes.filter(F.col("side") == s).select(F.col("no").alias(x), F.col("cls").alias(x + "c"), F.col("words").alias(x + "w"), F.col("n").alias(x + "n")), x)
    if scoped:  # pairs of long questions come from the other pass
        near = near.filter((F.col("en") < least_words) | (F.col("tn") < least_words))
    return _verified(near.select(F.col("ec").alias("e"), F.col("tc").alias("t"), "ew", "tw"), share)


def question_classes(records: DataFrame, scoped: bool, share: float, least_words: int) -> tuple[DataFrame, DataFrame]:
    """The rows that take part with their class, and the classes (no, cls, side, scope, words, n, map), written by side."""
    reach = int(np.floor((least_words - 1) / share + 1e-9))  # words of the longest question that a short one can overlap with
    rows = records.filter(f"n <= {reach} AND doc IS NOT NULL") if scoped else records.filter(f"n >= {least_words}")
    rows = rows.withColumn("scope", F.col("doc") if scoped else F.lit("")).withColumn("cls", F.xxhash64("side", "scope", "words"))
    classes = rows.groupBy("cls", "side", "scope", "words", "n", "map").agg(F.lit(1).alias("one")).drop("one")
    return rows, written(classes.withColumn("no", F.monotonically_increasing_id()), "classes", "side")


def overlapping_classes(df: DataFrame, record_id: str = "qa_id", doc_id: str = "doc_id", split: str = "split", question: str = "question", share: float = 0.7, least_words: int = 12, few: float = 1.0, hot: float = 4096.0) -> tuple[DataFrame, DataFrame]:
    """Pairs (e, t) of classes of equal questions that overlap, and the members (side, cls, id, doc, words) of every class."""
    records = written(_records(df, record_id, doc_id, split, question), "questions")
    pairs = df.sparkSession.createDataFrame([], "e long, t long")
    members = []
    for scoped in (False, True):
        rows, classes = question_classes(records, scoped, share, least_words)
        members.append(rows.select("side", "cls", "id", "doc", "words"))
        found = _class_pairs(classes, scoped, share, least_words, few, hot)
        pairs = pairs if found is None else pairs.unionByName(found)
    return pairs, members[0].unionByName(members[1])


def _of_side(members: DataFrame, side: int, name: str) -> DataFrame:
    return members.filter(F.col("side") == side).select(F.col("cls").alias(name), F.col("id").alias(name + "_id"))


def overlapping_questions(df: DataFrame, **options) -> DataFrame:
    """Rows (train_id, eval_id): each pair of a train and a validation or test record whose questions overlap, once."""
    pairs, members = overlapping_classes(df, **options)
    found = pairs.join(_of_side(members, EVAL, "e").distinct(), "e").join(_of_side(members, TRAIN, "t").distinct(), "t")
    return found.select(F.col("t_id").alias("train_id"), F.col("e_id").alias("eval_id")).filter("train_id <> eval_id").distinct()


def found_pairs(df: DataFrame, **options) -> DataFrame:
    """Rows (qa_id_a, qa_id_b), smaller string first."""
    return overlapping_questions(df, **options).select(F.least("train_id", "eval_id").alias("qa_id_a"), F.greatest("train_id", "eval_id").alias("qa_id_b")).distinct()


def overlap_report(df: DataFrame, record_id: str = "qa_id", split: str = "split", source: str = "source", **options) -> DataFrame:
    """Per evaluation split and source: overlapping pairs, and evaluation records that overlap.

    Pairs are counted from the classes' sizes. Only ids that stand for several questions, whose pairs could come twice, are expanded."""
    pairs, members = overlapping_classes(df, record_id=record_id, split=split, **options)
    pairs = written(pairs, "pairs")
    about = df.select(F.col(record_id).cast("string").alias("e_id"), split_name(F.col(split)).alias("split"), F.col(source).alias("source")).filter("split IN ('validation', 'test')").distinct()
    several = members.select("id", F.xxhash64("side", "doc", "words").alias("q")).groupBy("id").agg((F.min("q") < F.max("q")).alias("several"))
    members = written(members.select("side", "cls", "id").distinct().join(several, "id"), "members")
    plain = members.filter("NOT several")
    size = plain.filter(F.col("side") == TRAIN).groupBy(F.col("cls").alias("t")).agg(F.count("*").alias("c"))
    each = _of_side(plain, EVAL, "e").join(pairs.join(size, "t").groupBy("e").agg(F.sum("c").alias("pairs")), "e").select("e_id", "pairs")
    # A train id of several questions, else an evaluation id of several.
    for trains, evals in ((members.filter("several"), members), (plain, members.filter("several"))):
        both = pairs.join(_of_side(evals, EVAL, "e"), "e").join(_of_side(trains, TRAIN, "t"), "t").filter("e_id <> t_id").select("e_id", "t_id").distinct()
        each = each.unionByName(both.groupBy("e_id").agg(F.count("*").alias("pairs")))
    each = each.groupBy("e_id").agg(F.sum("pairs").alias("pairs"))
    return each.join(about, "e_id").groupBy("split", "source").agg(F.sum("pairs").alias("pairs"), F.count("*").alias("eval_records"))
