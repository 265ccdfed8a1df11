"""Places for engines that aren't part of this library: recognition, image preparation, language models. Each is loaded once a task.

An engine is given as a function without arguments that returns the engine; it runs on the executors, in Arrow batches. Where none is given,
the token tables (or no model questions) are the default, so nothing here is needed to use the library.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "doc_id string, token_id int, text string, confidence double, xmin double, ymin double, xmax double, ymax double, error string"

#: Engine: image bytes to a list of (text, confidence or None, corners or None).
Recognizer = Callable[[bytes], list[tuple[str, float | None, list[list[float]] | None]]]


def target_size(width: Column, height: Column, longest: int = 2500) -> tuple[Column, Column]:
    """Size after the longer side is brought down to ``longest``; the other side is cut to whole pixels."""
    long = F.greatest(width, height)
    scale = F.lit(float(longest)) / long
    w = F.when(width >= height, F.lit(longest)).otherwise((width * scale).cast("int"))
    h = F.when(width >= height, (height * scale).cast("int")).otherwise(F.lit(longest))
    return F.when(long > longest, w).otherwise(width), F.when(long > longest, h).otherwise(height)


def recognize(images: DataFrame, load: Callable[[], Recognizer], prepare: Callable[[bytes], bytes] | None = None, doc_id: str = "doc_id", content: str = "content") -> DataFrame:
    """Tokens of each image. Blank texts are dropped, a missing score is 0, a missing box null; an image that fails or has no token gives one
    row with an error and no token. ``prepare`` changes the image first; if it fails, the image is used as it is."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = load()
        for batch in batches:
            rows = []
            for doc, data in zip(batch["d"], batch["c"]):
                try:
                    image = bytes(data)
                    if prepare:
                        try:
                            image = prepare(image)
                        except Exception:  # noqa: BLE001
                            pass
                    found = [(t, s, b) for t, s, b in engine(image) if t and t.strip()]
                    error = None if found else "no text"
                except Exception as x:  # noqa: BLE001
                    found, error = [], str(x) or type(x).__name__
                for k, (t, s, b) in enumerate(found):
                    xs, ys = ([p[0] for p in b], [p[1] for p in b]) if b else ([None], [None])
                    rows.append((doc, k, t, s or 0.0, *((min(xs), min(ys), max(xs), max(ys)) if b else (None,) * 4), None))
                if error:
                    rows.append((doc, None, None, None, None, None, None, None, error))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in RESULT.split(", ")])

    return images.select(F.col(doc_id).cast("string").alias("d"), F.col(content).alias("c")).mapInPandas(run, RESULT)


def complete(prompts: DataFrame, load: Callable[[], Callable[[list[str]], list[str]]], prompt: str = "prompt") -> DataFrame:
    """Adds ``reply``: a model's answers to batches of prompts; null for a batch on which it fails."""
    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for b in batches:
            try:
                yield pd.Series(model(b.tolist()))
            except Exception:  # noqa: BLE001
                yield pd.Series([None] * len(b))

    return prompts.withColumn("reply", ask(F.col(prompt)))
