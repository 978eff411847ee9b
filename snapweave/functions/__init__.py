"""Column expressions: presence masks, label matching, snapshot times."""

from .labels import (nearest_index, nearest_label, path_value, resolve_label, snapshot_time_ms,
                     snapshot_times)
from .mask import (LEGEND_KEY, MASK_COLUMN, MaskLayout, attach_legend, bit_is_set, first_set,
                   last_set, legend_of, one_hot_words, realign_words, render_mask,
                   resolve_legend, with_legend)

__all__ = [
    "nearest_index", "nearest_label", "path_value", "resolve_label", "snapshot_time_ms", "snapshot_times",
    "LEGEND_KEY", "MASK_COLUMN", "MaskLayout", "attach_legend", "bit_is_set", "first_set",
    "last_set", "legend_of", "one_hot_words", "realign_words", "render_mask",
    "resolve_legend", "with_legend",
]
