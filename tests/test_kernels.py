import numpy as np
import pyarrow as pa
import pytest

from gevel.functions import kernels as K
from tests.shapes import ARROW_RINGS, HOLED, box, inside, raster, rings


def covered(subject, others, frame=None):
    f = None if frame is None else pa.array(frame, ARROW_RINGS)
    return K.covered_area_batch(pa.array(subject, ARROW_RINGS), pa.array(others, pa.list_(ARROW_RINGS)), f)


@pytest.mark.parametrize(
    "subject, others, want",
    [
        (box(0, 0, 4, 4), [box(2, 2, 6, 6)], 4.0),
        (box(0, 0, 4, 4), [box(0, 0, 2, 4), box(1, 0, 2, 4)], 8.0),
        (HOLED, [box(0, 0, 4, 2)], 6.0),
        (rings([(0, 0), (4, 0), (2, 4)]), [rings([(0, 3), (4, 3), (2, -1)])], 5.25),
        (box(0, 0, 4, 4), [box(4, 0, 8, 4)], 0.0),
        (box(0, 0, 4, 4), [], 0.0),
        (box(0, 0, 4, 4), [HOLED], 12.0),
    ],
)
def test_covered_area_by_hand(subject, others, want):
    assert covered([subject], [others])[0] == pytest.approx(want)


def test_frame_limits_the_area():
    got = covered([box(0, 0, 4, 4)] * 2, [[box(1, 1, 3, 3)]] * 2, [box(0, 0, 2, 2), []])
    assert list(got) == [1.0, 4.0]


def test_covered_area_against_a_raster():
    rng = np.random.default_rng(3)
    x, y, unit = raster()

    def blob():
        n = rng.integers(3, 7)
        a = np.sort(rng.uniform(0, 2 * np.pi, n))
        c, r = rng.uniform(1, 3, 2), rng.uniform(0.3, 1.5, n)
        return rings(list(zip(c[0] + r * np.cos(a), c[1] + r * np.sin(a))))

    subjects = [blob() for _ in range(12)]
    others = [[blob() for _ in range(rng.integers(0, 5))] for _ in subjects]
    got = covered(subjects, others)
    for s, o, v in zip(subjects, others, got):
        any_other = np.any([inside(q, x, y) for q in o], axis=0) if o else np.zeros(len(x), bool)
        assert v == pytest.approx((inside(s, x, y) & any_other).sum() * unit, abs=0.02)


def test_intersects_includes_touching_and_containment():
    left = [box(0, 0, 1, 1), box(0, 0, 1, 1), box(0, 0, 9, 9), box(2, 2, 3, 3), HOLED, HOLED]
    right = [box(1, 1, 2, 2), box(1.1, 0, 2, 2), box(2, 2, 3, 3), box(0, 0, 9, 9), box(1.5, 1.5, 2, 2), box(1, 1, 3, 3)]
    got = K.intersects_batch(pa.array(left, ARROW_RINGS), pa.array(right, ARROW_RINGS))
    assert list(got) == [True, False, True, True, False, True]


def test_pair_blocks_do_not_change_the_answer(monkeypatch):
    left, right = [HOLED, box(0, 0, 1, 1)] * 3, [box(1.5, 1.5, 5, 5), box(3, 3, 4, 4)] * 3
    a, b = pa.array(left, ARROW_RINGS), pa.array(right, ARROW_RINGS)
    whole = list(K.intersects_batch(a, b))
    monkeypatch.setattr(K, "PAIR_BLOCK", 5)
    assert list(K.intersects_batch(a, b)) == whole == [True, False] * 3


def test_mitre_buffer_corners_and_holes():
    out = K.mitre_batch(pa.array([box(0, 0, 2, 2), HOLED], ARROW_RINGS), 0.1).to_pylist()
    assert [(p["x"], p["y"]) for p in out[0][0]] == [(-0.1, -0.1), (2.1, -0.1), (2.1, 2.1), (-0.1, 2.1), (-0.1, -0.1)]
    hole = {(round(p["x"], 6), round(p["y"], 6)) for p in out[1][1]}
    assert hole == {(1.1, 1.1), (2.9, 1.1), (2.9, 2.9), (1.1, 2.9)}


def test_mitre_buffer_cuts_sharp_corners():
    out = K.mitre_batch(pa.array([rings([(0, 0), (10, 0), (0, 0.5)])], ARROW_RINGS), 0.1).to_pylist()[0][0]
    assert len(out) == 5
    assert max(p["x"] for p in out) < 10.0 + 0.1 * 5.1


def test_clockwise_input_grows_too():
    cw = rings([(0, 0), (0, 2), (2, 2), (2, 0)])
    xs = [p["x"] for p in K.mitre_batch(pa.array([cw], ARROW_RINGS), 0.1).to_pylist()[0][0]]
    assert min(xs) == pytest.approx(-0.1) and max(xs) == pytest.approx(2.1)


def test_simplified_count():
    a = rings([(0, 0), (1, 0.05), (2, 0), (2, 2), (0, 2)])
    b = rings([(0, 0), (1, 0.5), (2, 0), (2, 2), (0, 2)])
    assert list(K.simplified_count_batch(pa.array([a, b, box(0, 0, 1, 1)], ARROW_RINGS), 0.1)) == [5, 6, 5]


def test_simple_flag():
    bow = rings([(0, 0), (2, 2), (2, 0), (0, 2)])
    assert list(K.simple_batch(pa.array([box(0, 0, 2, 2), bow], ARROW_RINGS))) == [True, False]
