"""Tunables of the layout, graph, normaliser and question stages, with the defaults that results are defined by."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LayoutConfig:
    min_y_overlap: float = 0.5
    center_share: float = 0.3
    gap_chars: float = 3.0
    line_gap: float = 20.0
    same_edge_share: float = 0.05
    min_x_overlap: float = 0.3
    default_char_width: float = 10.0
    default_line_height: float = 20.0
    top_hypotheses: int = 2
    min_scores: dict = field(default_factory=lambda: {"table": 0.25, "form": 0.20, "figure": 0.25, "text": 0.65})


@dataclass(frozen=True)
class GraphConfig:
    top_k: int = 5
    min_score: float = 0.2
    min_overlap: float = 0.3
    reach: float = 500.0
    near: float = 200.0
    caption_lines: int = 3
    caption_chars: int = 150
    text_chars: int = 200


@dataclass(frozen=True)
class NormConfig:
    lowercase: bool = True
    remove_punctuation: bool = False
    normalize_whitespace: bool = True
    normalize_numbers: bool = False
    remove_accents: bool = False
    fix_ocr_errors: bool = True


@dataclass(frozen=True)
class QAConfig:
    max_form: int = 5
    max_table: int = 5
    max_figure: int = 3
    max_text: int = 5
    max_per_document: int = 10
    long_words: int = 30
    longest_texts: int = 3
    summary_words: int = 30
    quote_chars: int = 300
    fallback_chars: int = 200
    title_words: tuple = (2, 25)
