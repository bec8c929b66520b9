"""SuperMinHash signatures.

Each element draws one random permutation of the slots and, in its order, values that
rise by one from draw to draw; a slot keeps the least value it is offered. Draws of an
element are correlated (no slot twice), which lowers the variance of the estimate below
that of independent permutations. An element stops as soon as every slot of its set
holds less than its next draw would offer, which in large sets is after very few draws.

All elements of many sets draw at the same time, as arrays.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.shingles import mix

_U = np.uint64
ELEMENTS_AT_ONCE = 100_000


def signatures(elements: np.ndarray, owners: np.ndarray, sets: int, slots: int) -> np.ndarray:
    """A row of `slots` values for each set; a set without elements has infinity in all of them."""
    values = np.full((sets, slots), np.inf)
    flat = values.reshape(-1)
    for at in range(0, len(elements), ELEMENTS_AT_ONCE):
        _offer(flat, elements[at : at + ELEMENTS_AT_ONCE], owners[at : at + ELEMENTS_AT_ONCE], slots)
    return values


def _offer(flat: np.ndarray, elements: np.ndarray, owners: np.ndarray, slots: int) -> None:
    values = flat.reshape(-1, slots)
    order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(elements), 1))
    live = np.arange(len(elements))
    for draw in range(slots):
        seed = mix(elements[live] + _U(draw * 0x9E3779B97F4A7C15 % (1 << 64)))
        value = (seed >> _U(11)).astype(np.float64) * 2.0**-53 + draw
        other = draw + ((mix(seed) >> _U(32)) * _U(slots - draw) >> _U(32)).astype(np.int64)
        slot = order[live, other]
        order[live, other] = order[live, draw]
        order[live, draw] = slot
        np.minimum.at(flat, owners[live] * slots + slot, value)
        # The greatest slot of a set says which of its elements can still lower one.
        low, high = owners[live[0]], owners[live[-1]] + 1
        open_sets = np.zeros(high - low, bool)
        present = np.unique(owners[live])
        open_sets[present - low] = values[present].max(axis=1) > draw + 1
        live = live[open_sets[owners[live] - low]]
        if not len(live):
            return


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each run of `rows` slots."""
    bits = values.view(np.uint64)
    keys = np.zeros((len(values), values.shape[1] // rows), np.uint64)
    for j in range(rows):
        keys = mix(keys * _U(3) + bits[:, j::rows][:, : keys.shape[1]])
    return keys
