import random

import numpy as np
import pytest

from terravane.functions import polygons as P


def scene(seed):
    rng = random.Random(seed)
    rings = [[], [(1.0, 1.0)], [(0.0, 0.0), (5.0, 5.0)], [(0.0, 0.0), (5.0, 5.0), (9.0, 9.0)]]
    for _ in range(150):
        x, y, size = rng.gauss(0, 90), rng.gauss(0, 90), 10 ** rng.uniform(0, 2.6)
        turns = sorted(rng.uniform(0, 2 * np.pi) for _ in range(rng.randrange(3, 12)))
        p = [(x + size * rng.uniform(0.2, 1) * np.cos(t), y + size * rng.uniform(0.2, 1) * np.sin(t)) for t in turns]
        p = p[::-1] if rng.random() < 0.5 else p
        rings.append([*p, p[0]] if rng.random() < 0.5 else p)
    rings += [[(-w, -h), (w, -h), (w, h), (-w, h)] for w, h in ((300, 300), (50, 400), (100, 100), (99.99, 5), (70, 70))]
    return rings + [[(100, -50), (200, -50), (200, 50), (100, 50)], [(0, 0), (100, 0), (100, 100), (0, 100)], [(-200, 99.995), (200, 99.995), (200, 120), (-200, 120)]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_many_rings_at_once_equal_one_by_one(seed):
    rings = scene(seed)
    flat = np.array([c for r in rings for c in r], float)
    many = P.Ragged(flat[:, 0], flat[:, 1], np.array([len(r) for r in rings]))
    each = [(i, s) for i, r in enumerate(rings) if len(s := P.ring(r))]
    assert many.which.tolist() == [i for i, _ in each]
    assert many.distances() == pytest.approx([P.distance(s) for _, s in each], abs=1e-9)
    areas, checked = many.areas_in_circle(100.0), 0
    for a, (_, s) in zip(areas, each, strict=True):
        if P.simple(s):
            checked += 1
            assert a == pytest.approx(P.union_area([s], P.circle(100.0)), abs=1e-5)
    assert checked > 40


def test_simple():
    square = [(0, 0), (4, 0), (4, 4), (0, 4)]
    assert P.simple(P.ring(square)) and P.simple(P.ring(square[::-1]))
    assert not P.simple(P.ring([(0, 0), (6, 6), (6, 0), (0, 4)])) and not P.simple(P.ring(square * 2))
