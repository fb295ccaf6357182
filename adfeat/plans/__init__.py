from adfeat.plans.frame import frame_features
from adfeat.plans.history import history_features, modular_features
from adfeat.plans.smoothing import item_smoothing, shop_smoothing, user_smoothing

__all__ = [
    "frame_features",
    "history_features",
    "item_smoothing",
    "modular_features",
    "shop_smoothing",
    "user_smoothing",
]
