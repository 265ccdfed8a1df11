"""Boxes and the spatial relations between them, as column expressions. A box is a struct (or prefix) of xmin, ymin, xmax, ymax."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafgraph.config import GraphConfig


def corners_bounds(box: Column) -> dict[str, Column]:
    """xmin, ymin, xmax, ymax of a box given as an array of corners; null if the box is null."""
    xs, ys = F.transform(box, lambda p: F.get(p, 0)), F.transform(box, lambda p: F.get(p, 1))
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def corners_center(box: Column) -> tuple[Column, Column]:
    """Mean of the corners, as the layout stage takes it; equal to the middle of the bounds for rectangles only."""
    mean = lambda k: F.try_divide(F.aggregate(box, F.lit(0.0), lambda s, p: s + F.get(p, k)), F.size(box))
    return mean(0), mean(1)


def rectangle(p: str = "") -> Column:
    """Bounds as four corners."""
    x1, y1, x2, y2 = (F.col(p + c) for c in ("xmin", "ymin", "xmax", "ymax"))
    return F.array(F.array(x1, y1), F.array(x2, y1), F.array(x2, y2), F.array(x1, y2))


def center_x(p: str) -> Column:
    return (F.col(p + "xmin") + F.col(p + "xmax")) / 2


def center_y(p: str) -> Column:
    return (F.col(p + "ymin") + F.col(p + "ymax")) / 2


def _overlap(a: str, b: str, lo: str, hi: str) -> Column:
    shared = F.greatest(F.lit(0.0), F.least(F.col(a + hi), F.col(b + hi)) - F.greatest(F.col(a + lo), F.col(b + lo)))
    least = F.least(F.col(a + hi) - F.col(a + lo), F.col(b + hi) - F.col(b + lo))
    return F.when(least > 0, F.try_divide(shared, least)).otherwise(0.0)


def overlap_x(a: str, b: str) -> Column:
    return _overlap(a, b, "xmin", "xmax")


def overlap_y(a: str, b: str) -> Column:
    return _overlap(a, b, "ymin", "ymax")


def iou(a: str, b: str) -> Column:
    """Intersection over union; 0 if the union is empty."""
    w = F.greatest(F.lit(0.0), F.least(F.col(a + "xmax"), F.col(b + "xmax")) - F.greatest(F.col(a + "xmin"), F.col(b + "xmin")))
    h = F.greatest(F.lit(0.0), F.least(F.col(a + "ymax"), F.col(b + "ymax")) - F.greatest(F.col(a + "ymin"), F.col(b + "ymin")))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, F.try_divide(w * h, union)).otherwise(0.0)


def area(p: str) -> Column:
    return (F.col(p + "xmax") - F.col(p + "xmin")) * (F.col(p + "ymax") - F.col(p + "ymin"))


def distance(a: str, b: str) -> Column:
    dx, dy = center_x(a) - center_x(b), center_y(a) - center_y(b)
    return F.sqrt(dx * dx + dy * dy)


def _beside(first: Column, shared: Column, gap: Column, c: GraphConfig) -> Column:
    near = F.greatest(F.lit(0.0), 1 - F.greatest(F.lit(0.0), gap) / c.reach)
    return F.when(first & (shared >= c.min_overlap), 0.6 * shared + 0.4 * near).otherwise(0.0)


def left_of(a: str, b: str, c: GraphConfig = GraphConfig()) -> Column:
    return _beside(center_x(a) < center_x(b), overlap_y(a, b), F.col(b + "xmin") - F.col(a + "xmax"), c)


def above(a: str, b: str, c: GraphConfig = GraphConfig()) -> Column:
    return _beside(center_y(a) < center_y(b), overlap_x(a, b), F.col(b + "ymin") - F.col(a + "ymax"), c)


def inside(a: str, b: str) -> Column:
    within = (F.col(a + "xmin") >= F.col(b + "xmin")) & (F.col(a + "ymin") >= F.col(b + "ymin")) & (F.col(a + "xmax") <= F.col(b + "xmax")) & (F.col(a + "ymax") <= F.col(b + "ymax"))
    return F.when(within & (area(b) != 0), 1 - F.try_divide(area(a), area(b))).otherwise(0.0)


def nearest(a: str, b: str, c: GraphConfig = GraphConfig()) -> Column:
    d = distance(a, b)
    return F.when(d <= c.near, F.greatest(F.lit(0.0), 1 - d / c.near)).otherwise(0.0)


def caption(a: str, b: str, c: GraphConfig = GraphConfig()) -> tuple[Column, Column]:
    """Relation name and score of the caption family; null where none holds. Needs region_type and is_short beside the bounds."""
    ta, tb, sa, sb = F.col(a + "region_type"), F.col(b + "region_type"), F.col(a + "is_short"), F.col(b + "is_short")
    of_object = lambda t: F.coalesce(t.isin("figure", "table"), F.lit(False))
    up, down = above(a, b, c), above(b, a, c)
    d = distance(a, b)
    cap = sa & of_object(tb)
    has = of_object(ta) & sb
    near_text = d < c.near
    tells = near_text & F.coalesce((ta == "table") & (tb == "text"), F.lit(False)) & ~sb
    told = near_text & F.coalesce((ta == "text") & (tb == "table"), F.lit(False)) & ~sa
    far = 0.7 * (1 - d / c.near)
    name = F.when(cap & ((up > 0) | (down > 0)), "is_caption_of").when(has & ((down > 0) | (up > 0)), "has_caption").when(tells, "has_explanation").when(told, "explains")
    score = (
        F.when(cap & (up > 0), 0.9 * up).when(cap & (down > 0), 0.8 * down).when(has & (down > 0), 0.9 * down).when(has & (up > 0), 0.8 * up).when(tells | told, far)
    )
    return name, score
