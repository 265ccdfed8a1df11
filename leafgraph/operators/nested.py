"""Deeply nested JSON text to flat, linked tables, by vectorised structural indexing.

A whole Arrow batch of payloads is one byte buffer. Over it are built, with NumPy only: the bitmap of unescaped quotes, the mask of bytes
inside strings (parity of a prefix sum), the positions of structural bytes outside strings, and the nesting depth (a prefix sum again).
From these come the elements: one row per value with its parent container, key, ordinal, kind and byte span. No JSON object is ever
materialised. The graph tables are then selections over that element index.

Defined results for odd input:

* null, empty or blank payloads, payloads that are cut off or otherwise not balanced, and error envelopes give no rows;
* a leading byte-order mark is skipped; a payload that is itself a JSON string holding JSON is decoded first (repeatedly);
* optional fields that are absent, null or of another type become null (in ``p5_found``: -1, or the position for a node id);
* ids given as text count as numbers; entries of an array that are not objects keep their position but give no row;
* repeated keys in one object: the last one holds; repeated rows come out once;
* other columns of the input are ignored; their names can't clash, as only the two named ones are selected.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_QUOTE, _BACKSLASH = 0x22, 0x5C
_LBRACE, _RBRACE, _LBRACKET, _RBRACKET, _COLON, _COMMA = b"{}[]:,"
_INT = re.compile(rb"-?\d+")
_SCALAR = re.compile(rb'(?:"(?:[^"\\]|\\.)*"|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null)', re.S)

#: Names under which a batch of documents, the payload of an envelope and the graph part of a full export stand.
_BATCH, _ENVELOPE, _PART = b"documents", b"data", b"graph"

DOC_FIELDS = "version string, created_at string, source_image string, num_regions long, num_nodes long, num_edges long"


@dataclass
class Index:
    """Element index of one buffer. Per element: record, parent container (-1: root), key span, ordinal, kind, container, value span."""

    buf: bytes
    rec: np.ndarray
    parent: np.ndarray
    key_from: np.ndarray
    key_to: np.ndarray
    ordinal: np.ndarray
    kind: np.ndarray  # b"o", b"a" or b"s"
    container: np.ndarray
    val_from: np.ndarray
    val_to: np.ndarray
    valid: np.ndarray  # per record
    depth: np.ndarray


def _decode(text: str | None) -> bytes:
    """The JSON text proper: without a mark, and out of any string that it was encoded into."""
    for _ in range(4):
        text = (text or "").lstrip("\ufeff \t\r\n").rstrip()
        if not text.startswith('"'):
            break
        try:
            text = json.loads(text)
        except ValueError:
            return b""
    return text.encode("utf-8", "surrogatepass")


def build_index(payloads: list[str | None]) -> Index:
    """Structural index of the payloads, each a record."""
    parts = [_decode(p) for p in payloads]
    buf = b"\n".join(parts) + b"\n"
    b = np.frombuffer(buf, np.uint8)
    sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    n = len(b)

    # Quotes that no odd run of backslashes precedes.
    quotes = np.flatnonzero(b == _QUOTE)
    is_bs = b == _BACKSLASH
    if is_bs.any():
        last_other = np.maximum.accumulate(np.where(is_bs, -1, np.arange(n)))
        before = quotes - 1
        run = np.where(before >= 0, before - last_other[np.maximum(before, 0)], 0)
        quotes = quotes[run % 2 == 0]
    quote_map = np.zeros(n + 1, np.int32)
    quote_map[quotes + 1] = 1
    quotes_before = np.cumsum(quote_map)  # unescaped quotes before each byte

    # Structural bytes outside strings; a record's strings are counted from its own start.
    where = np.flatnonzero(np.isin(b, np.frombuffer(b"{}[]:,", np.uint8)))
    rec = np.searchsorted(ends, where, side="right")
    outside = (quotes_before[where] - quotes_before[starts[rec]]) % 2 == 0
    where, rec = where[outside], rec[outside]
    ch = b[where]
    opens, closes = (ch == _LBRACE) | (ch == _LBRACKET), (ch == _RBRACE) | (ch == _RBRACKET)
    total = np.concatenate(([0], np.cumsum(opens.astype(np.int64) - closes)))
    first = np.searchsorted(rec, np.arange(len(parts)))
    last = np.searchsorted(rec, np.arange(len(parts)), side="right")
    level = total[1:] - total[first][rec] + closes  # depth of the container that the byte belongs to

    valid = (quotes_before[ends] - quotes_before[starts]) % 2 == 0
    valid &= (total[last] == total[first]) & (last > first)
    ok = np.flatnonzero(valid)
    valid[ok] &= opens[first[ok]] & closes[last[ok] - 1] & (where[first[ok]] == starts[ok]) & (where[last[ok] - 1] == ends[ok] - 2)
    low = np.flatnonzero(level < 1)
    valid[rec[low]] = False
    keep = valid[rec]
    where, rec, ch, opens, closes, level = (x[keep] for x in (where, rec, ch, opens, closes, level))
    m = len(where)

    # The container of each structural byte: the last opening at its level. A stable sort by record and level brings both together.
    order = np.lexsort((np.arange(m), level, rec))
    filled = np.maximum.accumulate(np.where(opens[order], np.arange(m), -1)) if m else np.empty(0, np.int64)
    container = np.empty(m, np.int64)
    container[order] = order[filled]
    bad = closes & (ch[container] + 2 != ch)  # in ASCII a closing bracket is its opening one plus 2
    if bad.any():
        valid[rec[bad]] = False
    in_array = ch[container] == _LBRACKET
    commas = ch == _COMMA
    comma_rank = np.cumsum(commas[order]) if m else np.empty(0, np.int64)
    ordinal = np.empty(m, np.int64)
    ordinal[order] = comma_rank
    ordinal -= ordinal[container]  # commas of this container so far (an opening is no comma)

    # Slots for values: after '[' or ',' of an array and after ':' of an object; the root is a slot too.
    nxt = np.append(where[1:], n) if m else where
    nxt_idx = np.arange(m) + 1
    slot = (in_array & (opens | commas)) | (~in_array & (ch == _COLON))
    slots = np.flatnonzero(slot)
    after = np.minimum(nxt_idx[slots], max(m - 1, 0))
    nested = opens[after] & (nxt_idx[slots] < m)
    val_from, val_to = where[slots] + 1, nxt[slots]
    scalar_blank = ~nested & _blank(b, val_from, val_to)
    empty_array = scalar_blank & (ch[slots] == _LBRACKET) & closes[after]
    wrong = scalar_blank & ~empty_array
    if wrong.any():
        valid[rec[slots[wrong]]] = False
    slots, nested, val_from, val_to, after = (x[~scalar_blank] for x in (slots, nested, val_from, val_to, after))
    key_from, key_to = np.zeros(len(slots), np.int64), np.zeros(len(slots), np.int64)
    of_object = np.flatnonzero(ch[slots] == _COLON)
    if len(of_object):  # keys are the strings before the colons
        close_q = np.maximum(np.searchsorted(quotes, where[slots[of_object]]) - 1, 1)
        key_from[of_object] = quotes[close_q - 1] + 1
        key_to[of_object] = quotes[close_q]
    roots = first_of(rec)
    return Index(
        buf=buf,
        rec=np.concatenate((rec[roots], rec[slots])),
        parent=np.concatenate((np.full(len(roots), -1), container[slots])),
        key_from=np.concatenate((np.zeros(len(roots), np.int64), key_from)),
        key_to=np.concatenate((np.zeros(len(roots), np.int64), key_to)),
        ordinal=np.concatenate((np.zeros(len(roots), np.int64), ordinal[slots])),
        kind=np.concatenate((np.where(ch[roots] == _LBRACE, b"o", b"a"), np.where(nested, np.where(ch[after] == _LBRACE, b"o", b"a"), b"s"))).astype("S1"),
        container=np.concatenate((roots, np.where(nested, after, -1))),
        val_from=np.concatenate((where[roots], val_from)),
        val_to=np.concatenate((np.full(len(roots), n), val_to)),
        valid=valid,
        depth=np.concatenate((np.zeros(len(roots), np.int64), level[slots])),
    )


def first_of(sorted_ids: np.ndarray) -> np.ndarray:
    """Positions where a new id begins."""
    return np.flatnonzero(np.diff(sorted_ids, prepend=-1) != 0) if len(sorted_ids) else np.empty(0, np.int64)


def _blank(b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which spans hold white space only."""
    ink = np.concatenate(([0], np.cumsum(b > 0x20)))
    return ink[hi] == ink[lo]


class Reader:
    """Selections over an index: children of a container by key, numbers and texts of scalars."""

    def __init__(self, index: Index):
        self.x = index
        self.order = np.lexsort((index.ordinal, index.parent))
        self.sorted_parent = index.parent[self.order]
        self.b = np.frombuffer(index.buf, np.uint8)
        self._named: dict[bytes, dict[int, int]] = {}

    def children(self, container: int) -> np.ndarray:
        lo, hi = np.searchsorted(self.sorted_parent, (container, container + 1))
        return self.order[lo:hi]

    def named(self, key: bytes) -> dict[int, int]:
        """Container to its element of that key; the key is compared byte by byte over all elements at once."""
        if key not in self._named:
            x = self.x
            hit = np.flatnonzero((x.key_to - x.key_from == len(key)) & (x.parent >= 0))
            for i, c in enumerate(key):
                hit = hit[self.b[x.key_from[hit] + i] == c]
            self._named[key] = dict(zip(x.parent[hit].tolist(), hit.tolist()))
        return self._named[key]

    def get(self, container: int, key: bytes) -> int:
        return self.named(key).get(container, -1)

    def raw(self, e: int) -> bytes:
        return self.x.buf[self.x.val_from[e] : self.x.val_to[e]].strip()

    def key(self, e: int) -> bytes:
        return self.x.buf[self.x.key_from[e] : self.x.key_to[e]]

    def number(self, e: int) -> int | None:
        """A whole number, plain or as text; else None."""
        return _whole(self.raw(e)) if e >= 0 and self.x.kind[e] == b"s" else None

    def real(self, e: int) -> float | None:
        if e < 0 or self.x.kind[e] != b"s":
            return None
        try:
            v = float(self.raw(e).strip(b'"'))
            return v if np.isfinite(v) else None
        except ValueError:
            return None

    def text(self, e: int) -> str | None:
        """A string, or a number as written; None for null, other kinds and bad escapes."""
        if e < 0 or self.x.kind[e] != b"s" or (r := self.raw(e)) == b"null":
            return None
        if r[:1] != b'"':
            return r.decode("utf-8", "replace")
        if b"\\" not in r:
            return r[1:-1].decode("utf-8", "replace")
        try:
            return json.loads(r.decode("utf-8", "replace")).encode("utf-8", "replace").decode()
        except ValueError:
            return None

    def obj(self, container: int, key: bytes) -> int:
        """The container of an object under a key, or -1."""
        e = self.get(container, key)
        return int(self.x.container[e]) if e >= 0 and self.x.kind[e] == b"o" else -1

    def box(self, e: int) -> list[float] | None:
        """Bounds xmin, ymin, xmax, ymax of a box as corners, as points with x and y, or as four numbers."""
        if e < 0 or self.x.kind[e] != b"a":
            return None
        xs: list[float | None] = []
        ys: list[float | None] = []
        items = self.children(int(self.x.container[e]))
        flat = [self.real(i) for i in items if self.x.kind[i] == b"s"]
        if len(flat) == len(items) == 4:
            xs, ys = [flat[0], flat[2]], [flat[1], flat[3]]
        else:
            for i in items:
                c = int(self.x.container[i])
                if self.x.kind[i] == b"a":
                    point = [self.real(j) for j in self.children(c)]
                elif self.x.kind[i] == b"o":
                    point = [self.real(self.get(c, b"x")), self.real(self.get(c, b"y"))]
                else:
                    return None
                if len(point) != 2:
                    return None
                xs.append(point[0])
                ys.append(point[1])
        if not xs or None in xs or None in ys:
            return None
        return [min(xs), min(ys), max(xs), max(ys)]


def _whole(raw: bytes) -> int | None:
    raw = raw.strip(b'" ')
    if _INT.fullmatch(raw):
        v = int(raw)
        return v if -(2**63) <= v < 2**63 else None
    try:
        f = float(raw)
    except ValueError:
        return None
    return int(f) if f == f and abs(f) < 2**53 and f == int(f) else None


def _scalars_hold(r: Reader) -> np.ndarray:
    """Records all of whose scalars are JSON values; a payload cut inside a value and closed again is not."""
    x = r.x
    good = np.ones(len(x.valid), bool)
    for e in np.flatnonzero(x.kind == b"s"):
        raw = r.raw(e)
        if raw[:1] == b'"':
            if len(raw) < 2 or raw[-1:] != b'"':
                good[x.rec[e]] = False
        elif not _SCALAR.fullmatch(raw):
            good[x.rec[e]] = False
    return good


def _documents(r: Reader) -> Iterator[tuple[int, int, int, int]]:
    """Record, place in the batch, graph part and object that has the metadata, of each graph document."""
    x = r.x
    good = x.valid & _scalars_hold(r)
    for root in np.flatnonzero(x.parent == -1):
        rec, c = int(x.rec[root]), int(x.container[root])
        if not good[rec]:
            continue
        batch = c if x.kind[root] == b"a" else -1
        e = r.get(c, _BATCH) if batch < 0 else -1
        if e >= 0 and x.kind[e] == b"a":
            batch = int(x.container[e])
        docs = [(int(x.ordinal[i]), int(x.container[i])) for i in r.children(batch) if x.kind[i] == b"o"] if batch >= 0 else [(0, c)]
        for place, doc in docs:
            for _ in range(3):
                if _has_graph(r, doc) or r.obj(doc, _PART) >= 0 or (inner := r.obj(doc, _ENVELOPE)) < 0:
                    break
                doc = inner
            part = r.obj(doc, _PART)
            part = part if part >= 0 and not _has_graph(r, doc) else doc
            if _has_graph(r, part):
                yield rec, place, part, doc


def _has_graph(r: Reader, c: int) -> bool:
    return any(r.get(c, k) >= 0 for k in (b"nodes", b"edges", b"adjacency"))


def _array(r: Reader, c: int, key: bytes) -> np.ndarray:
    e = r.get(c, key)
    return r.children(int(r.x.container[e])) if e >= 0 and r.x.kind[e] == b"a" else np.empty(0, np.int64)


def _node_id(r: Reader, c: int, pos: int) -> int:
    for key in (b"node_id", b"id"):
        if (v := r.number(r.get(c, key))) is not None:
            return v
    return pos


def _neighbours(r: Reader, part: int) -> Iterator[tuple[int, int, int]]:
    """Position in the node's list, the node, its neighbour; from a map of lists or a list of objects."""
    x = r.x
    e = r.get(part, b"adjacency")
    if e < 0:
        return
    for i in r.children(int(x.container[e])) if x.kind[e] in (b"o", b"a") else ():
        if x.kind[e] == b"o":
            node, lst = _whole(r.key(i)), i
        elif x.kind[i] == b"o":
            c = int(x.container[i])
            node, lst = r.number(r.get(c, b"node")), r.get(c, b"neighbors")
        else:
            continue
        if node is None or lst < 0 or x.kind[lst] != b"a":
            continue
        for j in r.children(int(x.container[lst])):
            if (v := r.number(j)) is not None:
                yield int(x.ordinal[j]), node, v


def _links(ids: list, payloads: list[str | None]) -> dict[str, list]:
    r = Reader(build_index(payloads))
    x = r.x
    rows: dict[tuple, None] = {}
    for rec, place, part, doc in _documents(r):
        meta = r.obj(doc, b"metadata")
        counts = [r.number(r.get(meta, k)) if meta >= 0 else None for k in (b"num_nodes", b"num_edges")]
        here = (ids[rec], place)
        rows[(*here, "document", 0, *(-1 if v is None else v for v in counts))] = None
        for i in _array(r, part, b"nodes"):
            if x.kind[i] == b"o":
                pos = int(x.ordinal[i])
                rows[(*here, "node", pos, _node_id(r, int(x.container[i]), pos), -1)] = None
        for i in _array(r, part, b"edges"):
            if x.kind[i] == b"o":
                c = int(x.container[i])
                pair = [r.number(r.get(c, k)) for k in (b"source", b"target")]
                rows[(*here, "edge", int(x.ordinal[i]), *(-1 if v is None else v for v in pair))] = None
        for pos, node, other in _neighbours(r, part):
            rows[(*here, "neighbor", pos, node, other)] = None
    columns = list(zip(*rows)) or [()] * len(_LINK_NAMES)
    return {k: list(v) for k, v in zip(_LINK_NAMES, columns)}


_LINK_NAMES = ("record_id", "doc_pos", "child_kind", "pos", "key_a", "key_b")
_LINK_TYPES = pa.schema([("record_id", pa.int64()), ("doc_pos", pa.int32()), ("child_kind", pa.string()), ("pos", pa.int32()), ("key_a", pa.int64()), ("key_b", pa.int64())])
_BATCH_BYTES = 8 << 20


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and payloads in groups of bounded bytes, so that the bitmaps stay small whatever the batch."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(i)
            texts.append(t)
            size += len(t or "")
            if size >= _BATCH_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _rows_of(fn, types: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches):
            yield pa.RecordBatch.from_pydict(fn(ids, texts), schema=types)

    return run


def graph_links(df: DataFrame, record_id: str = "record_id", payload: str = "payload") -> DataFrame:
    """Documents, nodes, edges and neighbours of each payload as rows (record_id, doc_pos, child_kind, pos, key_a, key_b); see the module."""
    src = df.select(F.col(record_id).cast("long").alias("record_id"), F.col(payload).cast("string").alias("payload"))
    return src.mapInArrow(_rows_of(_links, _LINK_TYPES), "record_id long, doc_pos int, child_kind string, pos int, key_a long, key_b long")


_WIDE = pa.schema(
    [
        ("record_id", pa.int64()), ("doc_pos", pa.int32()), ("child_kind", pa.string()), ("pos", pa.int32()), ("node_id", pa.int64()), ("target", pa.int64()),
        ("label", pa.string()), ("category", pa.string()), ("score", pa.float64()), ("xmin", pa.float64()), ("ymin", pa.float64()), ("xmax", pa.float64()), ("ymax", pa.float64()),
        ("text", pa.string()), ("version", pa.string()), ("created_at", pa.string()), ("source_image", pa.string()), ("num_regions", pa.int64()), ("num_nodes", pa.int64()), ("num_edges", pa.int64()),
    ]
)
_WIDE_DDL = ", ".join(f"{f.name} {({pa.int64(): 'long', pa.int32(): 'int', pa.string(): 'string', pa.float64(): 'double'})[f.type]}" for f in _WIDE)


def _wide(ids: list, payloads: list[str | None]) -> dict[str, list]:
    r = Reader(build_index(payloads))
    x = r.x
    out: dict[str, list] = {f.name: [] for f in _WIDE}

    def put(**row) -> None:
        for k in out:
            out[k].append(row.get(k))

    for rec, place, part, doc in _documents(r):
        here = {"record_id": ids[rec], "doc_pos": place}
        meta = r.obj(doc, b"metadata")
        m = {k: r.get(meta, k.encode()) if meta >= 0 else -1 for k in ("source_image", "num_regions", "num_nodes", "num_edges")}
        put(**here, child_kind="document", pos=0, version=r.text(r.get(doc, b"version")), created_at=r.text(r.get(doc, b"created_at")), source_image=r.text(m["source_image"]),
            **{k: r.number(m[k]) for k in ("num_regions", "num_nodes", "num_edges")})
        for i in _array(r, part, b"nodes"):
            if x.kind[i] == b"o":
                c, pos = int(x.container[i]), int(x.ordinal[i])
                box = r.box(r.get(c, b"bbox")) or [None] * 4
                put(**here, child_kind="node", pos=pos, node_id=_node_id(r, c, pos), label=r.text(r.get(c, b"region_type")), score=r.real(r.get(c, b"score")),
                    text=r.text(r.get(c, b"text")), **dict(zip(("xmin", "ymin", "xmax", "ymax"), box)))
        for i in _array(r, part, b"edges"):
            if x.kind[i] == b"o":
                c = int(x.container[i])
                put(**here, child_kind="edge", pos=int(x.ordinal[i]), node_id=r.number(r.get(c, b"source")), target=r.number(r.get(c, b"target")),
                    label=r.text(r.get(c, b"relation")), category=r.text(r.get(c, b"category")), score=r.real(r.get(c, b"score")))
        for pos, node, other in dict.fromkeys(_neighbours(r, part)):
            put(**here, child_kind="neighbor", pos=pos, node_id=node, target=other)
    return out


def graph_tables(df: DataFrame, record_id: str = "record_id", payload: str = "payload") -> dict[str, DataFrame]:
    """Flat tables ``documents``, ``nodes``, ``edges`` and ``neighbors``, each row linked to its document by (record_id, doc_pos).

    An edge or neighbour may name a node that does not exist; it is kept, as the link is what the payload says."""
    src = df.select(F.col(record_id).cast("long").alias("record_id"), F.col(payload).cast("string").alias("payload"))
    wide = src.mapInArrow(_rows_of(_wide, _WIDE), _WIDE_DDL)
    link = ("record_id", "doc_pos")

    def kind(name: str) -> DataFrame:
        return wide.filter(F.col("child_kind") == name)

    return {
        "documents": kind("document").select(*link, "version", "created_at", "source_image", "num_regions", "num_nodes", "num_edges"),
        "nodes": kind("node").select(*link, "pos", "node_id", F.col("label").alias("region_type"), "score", "xmin", "ymin", "xmax", "ymax", "text"),
        "edges": kind("edge").select(*link, "pos", F.col("node_id").alias("source"), "target", F.col("label").alias("relation"), "score", "category"),
        "neighbors": kind("neighbor").select(*link, "pos", F.col("node_id").alias("node"), F.col("target").alias("neighbor")),
    }


_ELEMENT = pa.schema([("record_id", pa.int64()), ("element", pa.int64()), ("parent", pa.int64()), ("key", pa.string()), ("pos", pa.int32()), ("depth", pa.int32()), ("kind", pa.string()), ("value", pa.string())])
_ELEMENT_DDL = "record_id long, element long, parent long, key string, pos int, depth int, kind string, value string"


def _elements(ids: list, payloads: list[str | None]) -> dict[str, list]:
    r = Reader(build_index(payloads))
    x = r.x
    good = x.valid & _scalars_hold(r)
    out: dict[str, list] = {f.name: [] for f in _ELEMENT}
    by_container = dict(zip(x.container[x.container >= 0].tolist(), np.flatnonzero(x.container >= 0).tolist()))
    start = np.full(len(x.valid) + 1, 0)
    keep = np.flatnonzero(good[x.rec])
    keep = keep[np.lexsort((x.val_from[keep], x.rec[keep]))]
    number: dict[int, int] = {}
    kinds = {b"o": "object", b"a": "array", b"s": "value"}
    for e in keep.tolist():
        rec = int(x.rec[e])
        number[e] = int(start[rec])
        start[rec] += 1
        parent = by_container.get(int(x.parent[e]), -1)
        kind = bytes(x.kind[e])
        row = (ids[rec], number[e], number.get(parent, -1), r.key(e).decode("utf-8", "replace") or None, int(x.ordinal[e]), int(x.depth[e]), kinds[kind], r.text(e) if kind == b"s" else None)
        for k, v in zip(out, row):
            out[k].append(v)
    return out


def json_elements(df: DataFrame, record_id: str = "record_id", payload: str = "payload") -> DataFrame:
    """Any JSON as a tree of rows: element and parent number within the record, key, position, depth, kind and the scalar's text.

    Elements are numbered in document order from 0 (the root, whose parent is -1), so a parent always has the lower number."""
    src = df.select(F.col(record_id).cast("long").alias("record_id"), F.col(payload).cast("string").alias("payload"))
    return src.mapInArrow(_rows_of(_elements, _ELEMENT), _ELEMENT_DDL)
