import numpy as np
import pytest

from shelfwise.llm.interpolated_lm import ASKED, _part, totals
from shelfwise.llm.packed import packed, packed_sorted, unpacked, unpacked_sorted


@pytest.mark.parametrize(
    "numbers", [[], [0], [0, 0, 0], [5_000_000_000, 1, 0], [2**64 - 1, 0, 2**63], list(range(70_000)), [255, 256, 65536]]
)
def test_numbers_come_back(numbers):
    x = np.array(numbers, dtype=np.uint64)
    assert unpacked(packed(x)).tolist() == numbers
    assert unpacked_sorted(packed_sorted(np.sort(x))).tolist() == sorted(numbers)


def test_hashes_are_packed_below_their_width_and_dealt_evenly():
    x = np.sort(np.random.default_rng(3).integers(0, 2**64, 400_000, dtype=np.uint64))
    assert (unpacked_sorted(packed_sorted(x)) == x).all() and len(packed_sorted(x)) < 8 * len(x)
    part = _part(x, 200_000)
    assert (np.diff(part) >= 0).all() and part.max() > 199_900
    loads = np.bincount(_part(x, 40_000), minlength=40_000)
    assert loads[:20_000].sum() / len(x) == pytest.approx(0.5, abs=0.01)


def test_totals_beyond_32_bits(spark):
    rows = [(1, 0, b, packed_sorted(np.array(k, np.uint64)), packed(np.array(c))) for b, k, c in (
        ("x", [7, 9], [3_000_000_000, 0]), ("y", [9], [5]), ("z", [7], [4_000_000_000]),
    )]
    got = {r.block: (unpacked(r.totals).tolist(), r.known) for r in totals(spark.createDataFrame(rows, ASKED)).collect()}
    assert {b: t for b, (t, _) in got.items()} == {"x": [7_000_000_000, 5], "y": [5], "z": [7_000_000_000]}
    assert sum(k for _, k in got.values()) == 2
