from .hashing import draw, unit_draw
from .scalars import (
    attack_family, band, binarize, float32_round, guarded_rate, is_benign, min_proba, percent, rate,
    sigmoid, step, strip,
)

__all__ = [
    "attack_family", "band", "binarize", "draw", "float32_round", "guarded_rate", "is_benign", "min_proba",
    "percent", "rate", "sigmoid", "step", "strip", "unit_draw",
]
