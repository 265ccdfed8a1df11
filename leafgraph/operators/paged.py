"""Layout and graph of whole pages, many pages at once in Arrow batches: the rules of ``layout`` and ``graph`` without a shuffle of tokens.

A page comes as one row with its tokens as an array and leaves as one row with its lines, blocks, regions, nodes and edges. Pages are taken
some ten thousands of tokens at a time; their tokens are columns of numbers then, and each rule is a sort or a sum by page, line or block.
``layout`` has the same rules for tokens as rows; ``tests/test_pages.py`` holds both against each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.config import GraphConfig, LayoutConfig
from leafgraph.operators import layout as L

_BOX = "xmin double,ymin double,xmax double,ymax double"
TOKEN = f"token_id int,text string,confidence double,{_BOX}"
PARTS = {
    "doc_id": "string",
    "error": "string",
    "tokens": f"array<struct<{TOKEN}>>",
    "lines": f"array<struct<line_id int,block_id int,text string,is_form boolean,form_key string,form_value string,{_BOX}>>",
    "blocks": f"array<struct<block_id int,lines bigint,{_BOX}>>",
    "regions": f"array<struct<region_id int,block_id int,region_type string,score double,{_BOX}>>",
    "nodes": "array<struct<node_id int,region_type string,bbox array<array<double>>,score double,text string>>",
    "edges": "array<struct<source int,target int,relation string,score double,category string>>",
    "adjacency": "map<string,array<int>>",
}
#: Tokens and pairs that are taken at a time (a page is never cut, its pairs are), and bands of a page in which lines are sought.
TOKENS_AT_ONCE, PAIRS_AT_ONCE, MOST_BANDS = 40_000, 250_000, 1000
_RELATIONS = pa.array(["left_of", "right_of", "above", "below", "inside", "contains", "nearest_neighbor", "is_caption_of", "has_caption", "has_explanation", "explains"])
_CATEGORIES = pa.array(["spatial"] * 6 + ["proximity"] + ["semantic"] * 4)
_KINDS = pa.array(L.KINDS)

# The patterns of ``functions.tokens`` and ``layout`` in Python's syntax. Java's \s under (?U) lacks the four separators that
# Python's has, its dot stops at more line ends; texts are stripped, so that $ is the end.
_S, _DOT = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000", r"[^\n\r\x85\u2028\u2029]"
_CLOCK = re.compile(rf"\d{{1,2}}:\d{{2}}(?::\d{{2}})?[{_S}]*[aApP]\.?[mM]\.?|^\d{{1,2}}:\d{{2}}\Z|^\d{{1,2}}:\d{{2}}:\d{{2}}\Z")
_FORM = re.compile(rf"^([A-Za-z][A-Za-z0-9{_S}\-_/.]{{0,38}}):[{_S}]*({_DOT}+)\Z")
_PAIR = re.compile(rf"^([^:]{{1,50}}):[{_S}]*({_DOT}+)\Z")
_LABEL = re.compile(r"[A-Za-z][A-Za-z0-9\s\-_/.]{0,35}:", re.ASCII)
_HOUR = re.compile(r"\d{1,2}:\d{2}", re.ASCII)
_TICK = re.compile(r"-?\d+\.?\d*\Z")


def packed(tokens: DataFrame) -> DataFrame:
    """A row for each page: (doc_id, tokens), the tokens by id."""
    has = set(tokens.columns)
    columns = [(F.col(c) if c in has else F.lit(None)).cast(kind).alias(c) for c, kind in (x.split(" ") for x in TOKEN.split(","))]
    return tokens.groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("tokens"))


def _firsts(ids: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)


def _places(ids: np.ndarray) -> np.ndarray:
    """Place of each element in its run of equal numbers, from 0."""
    first = _firsts(ids)
    return np.arange(len(ids)) - np.repeat(first, np.diff(np.r_[first, len(ids)]))


def _medians(values: np.ndarray, ids: np.ndarray, n: int, default: float) -> np.ndarray:
    """Median of the values of each of n ids; the default where there are none."""
    out = np.full(n, default)
    if len(values):
        v = values[np.lexsort((values, ids))]
        count = np.bincount(ids, minlength=n)
        at, some = np.cumsum(count) - count, count > 0
        lo, hi = v[(at + (count - 1) // 2)[some]], v[(at + count // 2)[some]]
        out[some] = np.where(lo == hi, lo, 0.5 * lo + 0.5 * hi)
    return out


def _joined_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each one's component, with the pairs (a, b) added to what ``root`` has."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up


def _spans(count: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of elements whose counts sum up to ``most`` at most, or of one element."""
    total, begin = np.cumsum(count), 0
    while begin < len(count):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + most, "right")))
        yield begin, end
        begin = end


def _near(ids: np.ndarray, who: np.ndarray, lo: np.ndarray, hi: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of one id where ``hi`` of a and ``lo`` of b are closer than a's reach. ``who``: the element that an entry of ids stands for.

    Entries lie on one axis, id behind id; what rounding there lets in too much is taken out by the rule itself."""
    tame = lambda v: np.clip(np.nan_to_num(v), -1e15, 1e15)
    x, y, r = tame(lo)[who], tame(hi)[who], np.maximum(tame(reach)[who], 0.0)
    least = min(x.min(), (y - r).min())
    axis = max(x.max(), (y + r).max()) - least + 1.0
    base = ids * axis - least
    slack = 1e-15 * (float(ids.max()) + 2) * axis
    order = np.argsort(base + x)
    points, member = (base + x)[order], who[order]
    first = np.searchsorted(points, base + (y - r) - slack, "left")
    count = np.maximum(np.searchsorted(points, base + (y + r) + slack, "right") - first, 0)
    for begin, end in _spans(count, PAIRS_AT_ONCE):
        n = count[begin:end]
        for part in _blocks(int(n.sum())):
            if begin + 1 == end:
                a, at = np.full(part[1] - part[0], who[begin]), first[begin] + np.arange(*part)
            else:
                a, at = np.repeat(who[begin:end], n), np.repeat(first[begin:end] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            b = member[at]
            keep = (a != b) & (np.abs(hi[a] - lo[b]) < reach[a])
            yield a[keep], b[keep]


def _blocks(n: int) -> Iterator[tuple[int, int]]:
    return ((k, min(n, k + PAIRS_AT_ONCE)) for k in range(0, n, PAIRS_AT_ONCE))


def _shared(lo: np.ndarray, hi: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Overlap of a and b on an axis as a share of the lesser extent."""
    la, ha, lb, hb = lo[a], hi[a], lo[b], hi[b]
    least = np.minimum(ha - la, hb - lb)
    both = np.maximum(0.0, np.minimum(ha, hb) - np.maximum(la, lb))
    return np.where(least > 0, both / np.where(least > 0, least, 1.0), 0.0)


def _field(text: str) -> tuple[str, str] | None:
    """``tokens.form_line``."""
    t = text.strip()
    m = _FORM.search(t)
    if not m or _CLOCK.search(t):
        return None
    key, value = m[1].strip(), m[2].strip()
    return (key, value) if len(key) <= 35 and key.count(" ") <= 4 and value else None


def _key_length(text: str) -> int:
    """Length of the label if the line is label and value (``layout.key_values``), else 0."""
    t = text.strip()
    m = _PAIR.search(t)
    if not m or _CLOCK.search(t):
        return 0
    key, value = m[1].strip(), m[2].strip()
    return len(key) if key and len(key) < 50 and value and not _CLOCK.search(key) else 0


def _join(texts: pa.Array, count: np.ndarray) -> pa.Array:
    """Texts one after the other with blanks between, ``count`` to each; nulls are left out."""
    if texts.null_count:
        there = texts.is_valid().to_numpy(zero_copy_only=False)
        count = np.bincount(np.repeat(np.arange(len(count)), count)[there], minlength=len(count))
        texts = texts.drop_null()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), texts), " ")


class _Sheet:
    """Lines, blocks, regions and edges of the pages of one batch. Tokens lie page by page, by id."""

    def __init__(self, pages: int, page: np.ndarray, text: pa.Array, box: list[np.ndarray], config: LayoutConfig):
        self.pages, self.page, self.text, self.config = pages, page, text, config
        self.box = box
        self._lines()
        self._rows()
        self._blocks()
        self._features()

    def _lines(self) -> None:
        (x1, y1, x2, y2), page, c = self.box, self.page, self.config
        self.length = np.nan_to_num(pc.utf8_length(self.text).to_numpy(zero_copy_only=False).astype(float))
        some = self.length > 0
        self.cw = (x2 - x1)[some] / self.length[some]
        char = _medians(self.cw, page[some], self.pages, c.default_char_width)
        height = _medians(y2 - y1, page, self.pages, c.default_line_height)
        pad = (c.center_share * height)[page]
        low, high = np.nan_to_num(np.minimum(y1, y2) - pad), np.nan_to_num(np.maximum(y1, y2) + pad)
        first = _firsts(page)
        least, most = np.full(self.pages, 0.0), np.full(self.pages, 0.0)
        least[page[first]], most[page[first]] = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
        size = np.maximum(4 * np.maximum(height, 1.0), (most - least) / MOST_BANDS)[page]
        band, last = (np.clip(np.floor((v - least[page]) / size), 0, MOST_BANDS).astype(np.int64) for v in (low, high))
        count = last - band + 1
        who = np.repeat(np.arange(len(page)), count)
        ids = page[who] * (MOST_BANDS + 1) + np.repeat(band - (np.cumsum(count) - count), count) + np.arange(count.sum())
        root, cy, reach = np.arange(len(page)), (y1 + y2) / 2, (c.gap_chars * char)[page]
        for a, b in _near(ids, who, x1, x2, reach):
            same = (_shared(y1, y2, a, b) >= c.min_y_overlap) | (np.abs(cy[a] - cy[b]) < (c.center_share * height)[page[a]])
            root = _joined_roots(root, a[same], b[same])
        self.cx = (x1 + x2) / 2
        heads = np.flatnonzero(root == np.arange(len(root)))
        line = np.searchsorted(heads, root)
        order = np.lexsort((self.cx, line))
        at = _firsts(line[order])
        bounds = [f.reduceat(v[order], at) for f, v in ((np.minimum, x1), (np.minimum, y1), (np.maximum, x2), (np.maximum, y2))]
        number = np.diff(np.r_[at, len(order)])
        texts = _join(self.text.take(pa.array(order)), number)
        down = np.lexsort((heads, (bounds[1] + bounds[3]) / 2, page[heads]))
        self.line = np.empty(len(down), np.int64)
        self.line[down] = np.arange(len(down))
        self.line = self.line[line]
        self.l_page, self.l_text, self.l_box, self.l_tokens = page[heads][down], texts.take(pa.array(down)), [v[down] for v in bounds], number[down]

    def _rows(self) -> None:
        """Lines with their fields; a line of several fields becomes a row each."""
        n = len(self.l_page)
        colon = np.flatnonzero(pc.match_substring(self.l_text, ":").to_numpy(zero_copy_only=False))
        one, several = {}, {}
        for i, t in zip(colon.tolist(), self.l_text.take(pa.array(colon)).to_pylist()):
            if t.count(":") >= 2 and sum(1 for _ in _LABEL.finditer(t)) >= 2:
                found = [] if _HOUR.search(t) else L.split_fields(t)
                if found:
                    several[i] = found
            elif f := _field(t):
                one[i] = f
        count = np.ones(n, np.int64)
        for i, found in several.items():
            count[i] = len(found)
        of = np.repeat(np.arange(n), count)
        first = np.cumsum(count) - count
        self.r_page, self.r_box, self.r_tokens = self.l_page[of], [v[of] for v in self.l_box], self.l_tokens[of]
        self.row = np.where(count == 1, first, -1)[self.line]
        keys, values, is_form = np.full(len(of), None, object), np.full(len(of), None, object), np.zeros(len(of), bool)
        self.r_text = self.l_text.take(pa.array(of))
        if several:
            texts = self.r_text.to_pylist()
            for i, found in several.items():
                left, width = self.l_box[0][i], self.l_box[2][i] - self.l_box[0][i]
                for k, f in enumerate(found, int(first[i])):
                    texts[k], keys[k], values[k], is_form[k] = f"{f['key']}: {f['value']}", f["key"], f["value"], True
                    self.r_box[0][k], self.r_box[2][k], self.r_tokens[k] = left + width * f["lo"], left + width * f["hi"], 0
            self.r_text = pa.array(texts, pa.string())
        for i, (key, value) in one.items():
            keys[first[i]], values[first[i]], is_form[first[i]] = key, value, True
        self.r_form, self.r_key, self.r_value = is_form, pa.array(keys, pa.string()), pa.array(values, pa.string())
        self.line_id = _places(self.r_page)

    def _blocks(self) -> None:
        (x1, y1, x2, y2), page, c = self.r_box, self.r_page, self.config
        edge = (c.same_edge_share * _medians(x2 - x1, page, self.pages, 0.0))[page]
        root, form = np.arange(len(page)), self.r_form
        for a, b in _near(page, root, y1, y2, np.full(len(page), c.line_gap)):
            same = (form[a] == form[b]) & ((np.abs(x1[a] - x1[b]) < edge[a]) | (~form[a] & (_shared(x1, x2, a, b) >= c.min_x_overlap)))
            root = _joined_roots(root, a[same], b[same])
        heads = np.flatnonzero(root == np.arange(len(root)))
        self.block, self.b_page = np.searchsorted(heads, root), page[heads]
        self.block_id = _places(self.b_page)

    def _features(self) -> None:
        """The scores of ``layout.hypotheses`` and the regions that are kept."""
        (x1, y1, x2, y2), block, nb = self.r_box, self.block, len(self.b_page)
        order = np.lexsort(((y1 + y2) / 2, block))
        at, ids = _firsts(block[order]), block[order]
        n = np.diff(np.r_[at, len(order)])
        self.b_lines = n
        self.b_box = [f.reduceat(v[order], at) for f, v in ((np.minimum, x1), (np.minimum, y1), (np.maximum, x2), (np.maximum, y2))]
        texts = self.r_text.take(pa.array(order))
        self.b_text = pc.utf8_slice_codeunits(_join(texts, n), 0, 200)
        length = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(float)
        self.b_chars = np.add.reduceat(length, at)

        def mean_sd(v: np.ndarray, use: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
            w = np.ones(len(v)) if use is None else use.astype(float)
            v = np.where(w > 0, v, 0.0)
            k = np.maximum(np.add.reduceat(w, at), 1.0)
            m = np.add.reduceat(v, at) / k
            return m, np.sqrt(np.add.reduceat(w * (v - m[ids]) ** 2, at) / k)

        share = lambda v: np.add.reduceat(v.astype(float), at) / n
        avg_len, sd_len = mean_sd(length)
        (m_left, sd_left), (m_right, sd_right) = mean_sd(x1[order]), mean_sd(x2[order])
        short, long = share(length < 40), share(length > 60)
        cy = ((y1 + y2) / 2)[order]
        later = np.ones(len(order), bool)
        later[at] = False
        m_gap, sd_gap = mean_sd(np.where(later, cy - np.r_[0.0, cy[:-1]], 0.0), later)
        counted = self.r_tokens[order]
        m_tok, sd_tok = mean_sd(counted.astype(float), counted > 0)
        has_tok, multi = np.add.reduceat((counted > 0).astype(int), at) > 0, share(counted >= 2)
        keys = np.zeros(len(order))
        colon = np.flatnonzero(pc.match_substring(texts, ":").to_numpy(zero_copy_only=False))
        keys[colon] = [_key_length(t) for t in texts.take(pa.array(colon)).to_pylist()]
        hits = np.add.reduceat((keys > 0).astype(int), at)
        ratio = hits / n
        pattern = (ratio >= 0.4) & (hits >= 2)
        num_cols, aligned, token_n, ticks, right_n, full = self._token_features(nb)

        even = lambda sd, m: 1 - np.minimum(1.0, sd / np.maximum(m, 1.0))
        consistency = np.where(has_tok, np.maximum(0.0, 1 - sd_tok / np.maximum(m_tok, 1.0)), 0.0)
        spread = np.where(m_gap > 0, sd_gap / np.where(m_gap > 0, m_gap, 1.0), 1.0)
        stable, w = aligned / n, L.TABLE_WEIGHTS
        looks = num_cols / L.TABLE_FULL_COLUMNS * w["columns"] + stable * w["stability"] + consistency * w["consistency"] + multi * w["several"] + (1 - np.minimum(1.0, spread)) * w["spacing"]
        table = np.where((n >= L.TABLE_LEAST_LINES) & (token_n >= L.TABLE_LEAST_TOKENS), looks, 0.0)
        left, right, uneven, limit = even(sd_left, m_left), even(sd_right, m_right), sd_len / np.maximum(avg_len, 1.0), L.JUSTIFIED_LIMITS
        justified = (left >= limit["left"]) & (right >= limit["right"]) & (long >= limit["long"]) & (avg_len > limit["length"])
        true_form = ((ratio >= 0.25) & (short >= 0.3) & (uneven > 0.25)) | ((ratio >= 0.1) & (left >= 0.65) & (right < 0.65) & (short >= 0.25))
        w, o = L.FORM_WEIGHTS, L.FORM_ELSE_WEIGHTS
        looks = ratio * w["colon"] + short * w["short"] + uneven * w["uneven"] + left * w["left"]
        form = np.select([n < 2, pattern, justified, true_form], [0.0, L.FORM_PATTERN_SCORE + ratio * L.FORM_PATTERN_WEIGHT, 0.0, looks], ratio * o["colon"] + left * o["left"])
        w = L.JUSTIFIED_WEIGHTS
        looks = (left + right) / 2 * w["edges"] + long * w["long"] + np.minimum(1.0, avg_len / L.FULL_LENGTH) * w["length"]
        boost = np.select([n < 2, pattern, justified, true_form], [0.0, L.BOOSTS["pattern"], looks, L.BOOSTS["form"]], 0.0)
        bx1, by1, bx2, by2 = self.b_box
        w = L.FIGURE_WEIGHTS
        figure = (1 - full / L.FIGURE_CELLS) * w["empty"] + np.minimum(1.0, ticks / L.FIGURE_FULL_TICKS) * w["ticks"] + (right_n >= L.FIGURE_LEGEND_TOKENS) * w["legend"]
        figure = np.where((bx1 == bx2) | (by1 == by2), 0.0, figure)
        w = L.TEXT_WEIGHTS
        spacing = np.where(n > 1, even(sd_gap, m_gap), 0.0)
        text = np.minimum(1.0, np.minimum(1.0, avg_len / L.FULL_LENGTH) * w["length"] + spacing * w["spacing"] + np.where(justified, w["justified"], 0.0) + boost)
        scores = np.stack([table, form, figure, np.where(n < 2, 0.0, text)], 1)
        ranked = np.argsort(-np.floor(scores * 1e9 + 0.5), axis=1, kind="stable")[:, : self.config.top_hypotheses]
        best = np.take_along_axis(scores, ranked, 1)
        keep = best >= np.array([self.config.min_scores[k] for k in L.KINDS])[ranked]
        self.n_block = np.repeat(np.arange(nb), keep.sum(1))
        self.n_kind, self.n_score, self.n_page = ranked[keep], best[keep], self.b_page[self.n_block]
        self.node_id = _places(self.n_page)

    def _token_features(self, nb: int) -> tuple[np.ndarray, ...]:
        """Columns, lines that stand in columns, tokens, ticks, tokens at the right and full cells of the middle, of each block (``layout._token_features``)."""
        used = np.flatnonzero(self.row >= 0)
        if not len(used):
            return (np.zeros(nb),) * 6
        x1, y1, x2, y2 = (v[used] for v in self.box)
        row, cx = self.row[used], self.cx[used]
        block = self.block[row]
        some = self.length[used] > 0
        char = _medians((x2 - x1)[some] / self.length[used][some], block[some], nb, self.config.default_char_width)
        total = lambda flag: np.bincount(block[flag], minlength=nb)
        bx1, by1, bx2, by2 = (v[block] for v in self.b_box)
        width, height = bx2 - bx1, by2 - by1
        text = self.text.take(pa.array(used))
        digit = np.flatnonzero(pc.match_substring_regex(text, r"\p{Nd}").fill_null(False).to_numpy(zero_copy_only=False))
        tick = np.zeros(len(used), bool)
        tick[digit] = [bool(_TICK.match(s)) and len(s) <= 6 for s in map(str.strip, text.take(pa.array(digit)).to_pylist())]
        at = lambda v, lo, extent: np.where(extent != 0, (v - lo) / np.where(extent != 0, extent, 1.0) * 20, 0.0).astype(np.int64)
        left, right = np.maximum(at(x1, bx1, width) - 5, 0), np.minimum(at(x2, bx1, width) - 5, 9)
        columns = np.where(left <= right, (1 << np.clip(right + 1, 0, 20)) - (1 << np.clip(left, 0, 20)), 0)
        full = np.zeros(nb)
        order = np.lexsort((cx, block))
        ids = block[order]
        first = _firsts(ids)
        for begin in (5, 10):
            lo, hi = np.maximum(at(y1, by1, height) - begin, 0), np.minimum(at(y2, by1, height) - begin, 4)
            rows = np.where(lo <= hi, ((1 << (10 * np.clip(hi + 1, 0, 5))) - (1 << (10 * np.clip(lo, 0, 5)))) // 1023, 0)
            full[ids[first]] += np.bitwise_count(np.bitwise_or.reduceat((columns * rows)[order], first))
        wide = np.maximum(50.0, 5 * char)[ids]
        x = cx[order]
        opens = np.r_[True, x[1:] - x[:-1] > wide[1:]]
        opens[first] = True
        column = opens & ~np.r_[opens[1:], True]
        run = np.cumsum(opens) - 1
        begin = np.flatnonzero(opens)
        size = np.diff(np.r_[begin, len(x)])
        middle = np.add.reduceat(x, begin) / size
        near = (size[run] >= 2) & (np.abs(x - middle[run]) < wide)
        lines = np.unique(row[order][near])
        return np.bincount(ids[column], minlength=nb), np.bincount(self.block[lines], minlength=nb), np.bincount(block, minlength=nb), total(tick), total(x1 > bx1 + 0.7 * width), full

    def edges(self, config: GraphConfig) -> tuple[np.ndarray, ...]:
        """(source, target, relation, score), the best of each source in order; nodes are counted through the batch."""
        none = np.zeros(0, np.int64)
        found = [(none, none, none, np.zeros(0))]
        count = np.bincount(self.n_page, minlength=self.pages)
        begin = (np.cumsum(count) - count)[self.n_page]
        partners = count[self.n_page]
        for lo, hi in _spans(partners, PAIRS_AT_ONCE):
            n = partners[lo:hi]
            a = np.repeat(np.arange(lo, hi), n)
            b = np.repeat(begin[lo:hi] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            other = a != b
            found.append(self._related(a[other], b[other], config))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _related(self, a: np.ndarray, b: np.ndarray, c: GraphConfig) -> tuple[np.ndarray, ...]:
        """Relations of the pairs (a, b), as in ``functions.geometry``; all pairs of a source are here."""
        x1, y1, x2, y2 = (v[self.n_block] for v in self.b_box)
        cx, cy, area = (x1 + x2) / 2, (y1 + y2) / 2, (x2 - x1) * (y2 - y1)
        across, down = _shared(y1, y2, a, b), _shared(x1, x2, a, b)

        def beside(first: np.ndarray, shared: np.ndarray, gap: np.ndarray) -> np.ndarray:
            near = np.maximum(0.0, 1 - np.maximum(0.0, gap) / c.reach)
            return np.where(first & (shared >= c.min_overlap), 0.6 * shared + 0.4 * near, 0.0)

        def inside(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            within = (x1[a] >= x1[b]) & (y1[a] >= y1[b]) & (x2[a] <= x2[b]) & (y2[a] <= y2[b]) & (area[b] != 0)
            return np.where(within, 1 - area[a] / np.where(area[b] != 0, area[b], 1.0), 0.0)

        above, below = beside(cy[a] < cy[b], down, y1[b] - y2[a]), beside(cy[b] < cy[a], down, y1[a] - y2[b])
        dx, dy = cx[a] - cx[b], cy[a] - cy[b]
        d = np.sqrt(dx * dx + dy * dy)
        scores = [beside(cx[a] < cx[b], across, x1[b] - x2[a]), beside(cx[b] < cx[a], across, x1[a] - x2[b]), above, below, inside(a, b), inside(b, a), np.where(d <= c.near, np.maximum(0.0, 1 - d / c.near), 0.0)]
        short = (self.n_kind == 3) & (self.b_lines[self.n_block] <= 3) & (self.b_chars[self.n_block] < 150)
        thing, table, prose = (self.n_kind == 0) | (self.n_kind == 2), self.n_kind == 0, self.n_kind == 3
        cap, has, near = short[a] & thing[b], thing[a] & short[b], d < c.near
        tells, told = near & table[a] & prose[b] & ~short[b], near & prose[a] & table[b] & ~short[a]
        either = (above > 0) | (below > 0)
        name = np.select([cap & either, has & either, tells, told], [7, 8, 9, 10], -1)
        caption = np.select([cap & (above > 0), cap & (below > 0), has & (below > 0), has & (above > 0), tells | told], [0.9 * above, 0.8 * below, 0.9 * below, 0.8 * above, 0.7 * (1 - d / c.near)], 0.0)
        hits = [np.flatnonzero(s >= c.min_score) for s in scores] + [np.flatnonzero((caption >= c.min_score) & (name >= 0))]
        at, score = np.concatenate(hits), np.concatenate([s[h] for s, h in zip([*scores, caption], hits)])
        kind = np.repeat(np.arange(8), [len(h) for h in hits])
        order = np.lexsort((kind, b[at], -score, a[at]))
        order = order[_places(a[at][order]) < c.top_k]
        at, kind = at[order], kind[order]
        return a[at], b[at], np.where(kind == 7, name[at], kind), score[order]


def _lists(page: np.ndarray, pages: int, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(page, minlength=pages))], pa.int32()), values)


def _struct(**columns) -> pa.Array:
    return pa.StructArray.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def _whole(v: np.ndarray) -> pa.Array:
    return pa.array(v.astype(np.int32))


def _bounds(box: list[np.ndarray]) -> dict[str, np.ndarray]:
    return dict(zip(L.BOUNDS, box))


def _corners(box: list[np.ndarray]) -> pa.Array:
    x1, y1, x2, y2 = box
    points = pa.array(np.stack([x1, y1, x2, y1, x2, y2, x1, y2], 1).ravel())
    steps = lambda n, size: pa.array(np.arange(0, n * size + 1, size), pa.int32())
    return pa.ListArray.from_arrays(steps(len(x1), 4), pa.ListArray.from_arrays(steps(4 * len(x1), 2), points))


def _adjacency(sheet: _Sheet, source: np.ndarray, target: np.ndarray) -> pa.Array:
    """Targets of each source by its number as text, in the order of such texts."""
    first = _firsts(source)
    heads, count = source[first], np.diff(np.r_[first, len(source)])
    ids, page = sheet.node_id[heads], sheet.n_page[heads]
    digits = np.char.str_len(ids.astype(str)) if len(ids) else np.zeros(0, np.int64)
    order = np.lexsort((digits, ids * 10 ** (digits.max(initial=1) - digits), page))
    n = count[order]
    at = np.repeat(first[order] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    near = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), _whole(sheet.node_id[target[at]]))
    per = np.bincount(page, minlength=sheet.pages)
    return pa.MapArray.from_arrays(pa.array(np.r_[0, np.cumsum(per)], pa.int32()), pa.array(ids[order]).cast(pa.string()), near)


def _laid_out(batch: pa.RecordBatch, config: LayoutConfig, graph: GraphConfig, parts: list[str]) -> dict[str, pa.Array]:
    """The parts of each page. Pages that fail, without a name or without tokens have none."""
    listed = batch.column("tokens")
    listed = listed.fill_null([]) if listed.null_count else listed
    count, tokens = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64), listed.flatten()
    pages = len(count)
    page = np.repeat(np.arange(pages), count)
    boxes = [tokens.field(c) for c in L.BOUNDS]
    missing = np.zeros(len(tokens), bool)
    for b in boxes:
        if b.null_count:
            missing |= ~b.is_valid().to_numpy(zero_copy_only=False)
    failed = np.bincount(page[missing], minlength=pages) > 0
    out = {"doc_id": batch.column("doc_id"), "tokens": listed, "error": pa.array(np.where(failed, "token without a box", None), pa.string())}
    good = ~failed & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    here = np.flatnonzero(good[page])
    if not len(here):
        return out | {p: pa.array([{} if PARTS[p].startswith("map") else []] * pages, _ARROW.field(p).type) for p in parts if p not in out}
    text, numbers = tokens.field("text"), [np.nan_to_num(b.to_numpy(zero_copy_only=False), nan=np.nan) for b in boxes]
    if len(here) < len(tokens):
        page, text, numbers = page[here], text.take(pa.array(here)), [v[here] for v in numbers]
    s = _Sheet(pages, page, text, numbers, config)
    n_box = [v[s.n_block] for v in s.b_box]
    kind = _KINDS.take(pa.array(s.n_kind))
    if "lines" in parts:
        out["lines"] = _lists(s.r_page, pages, _struct(line_id=_whole(s.line_id), block_id=_whole(s.block_id[s.block]), text=s.r_text, is_form=s.r_form, form_key=s.r_key, form_value=s.r_value, **_bounds(s.r_box)))
        out["blocks"] = _lists(s.b_page, pages, _struct(block_id=_whole(s.block_id), lines=s.b_lines.astype(np.int64), **_bounds(s.b_box)))
        out["regions"] = _lists(s.n_page, pages, _struct(region_id=_whole(s.node_id), block_id=_whole(s.block_id[s.n_block]), region_type=kind, score=s.n_score, **_bounds(n_box)))
    out["nodes"] = _lists(s.n_page, pages, _struct(node_id=_whole(s.node_id), region_type=kind, bbox=_corners(n_box), score=s.n_score, text=s.b_text.take(pa.array(s.n_block))))
    source, target, relation, score = s.edges(graph)
    relation = pa.array(relation)
    edges = _struct(source=_whole(s.node_id[source]), target=_whole(s.node_id[target]), relation=_RELATIONS.take(relation), score=score, category=_CATEGORIES.take(relation))
    out["edges"] = _lists(s.n_page[source], pages, edges)
    out["adjacency"] = _adjacency(s, source, target)
    return out


def _arrow(kind: str) -> pa.DataType:
    """The Arrow type of a type as in ``PARTS``."""
    inner = kind[kind.find("<") + 1 : -1]
    if kind.startswith("array<"):
        return pa.list_(_arrow(inner))
    if kind.startswith("map<"):
        return pa.map_(*map(_arrow, inner.split(",", 1)))
    if kind.startswith("struct<"):
        return pa.struct([(c.split(" ", 1)[0], _arrow(c.split(" ", 1)[1])) for c in re.split(r",(?=\w+ )", inner)])
    return {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[kind]


_ARROW = pa.schema([(k, _arrow(v)) for k, v in PARTS.items()])


def pages(sheets: DataFrame, parts: list[str], config: LayoutConfig = LayoutConfig(), graph: GraphConfig = GraphConfig()) -> DataFrame:
    """The named ``PARTS`` of each page of ``sheets`` (doc_id, tokens); all but doc_id, tokens and error are empty for pages that fail."""
    wanted = pa.schema([_ARROW.field(p) for p in parts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _spans(np.nan_to_num(pc.list_value_length(batch.column("tokens")).to_numpy(zero_copy_only=False).astype(float)), TOKENS_AT_ONCE):
                out = _laid_out(batch.slice(lo, hi - lo), config, graph, parts)
                yield pa.RecordBatch.from_arrays([out[p].cast(wanted.field(p).type) for p in parts], schema=wanted)

    return sheets.select("doc_id", "tokens").mapInArrow(run, ", ".join(f"{p} {PARTS[p]}" for p in parts))
