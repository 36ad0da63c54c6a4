"""Which rings have the largest shares of a circle, for the sites of a block and all rings that their circles can reach.

Rings are looked at from the largest to the smallest; a ring is measured only where the bound of its share comes before the
last of those found so far. Upright rectangles are measured by a closed form, other rings edge by edge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from ..functions import polygons as P
from ..functions.geo import FLAT_M
from .blocks import _spread

AT_ONCE = 256  # sites, and rings, that are looked at together
MOST_CORNERS = 1 << 19  # that are measured together
BITS = 26  # of a key for the place of a ring in the order of ids; the others are for hundredths of hectares


class Rings(NamedTuple):
    """In the order of their ids: boxes in degrees, kind, and corners in degrees, ring after ring (n of them; none for
    upright rectangles)."""

    south: np.ndarray
    north: np.ndarray
    west: np.ndarray
    east: np.ndarray
    upright: np.ndarray
    simple: np.ndarray
    lat: np.ndarray
    lng: np.ndarray
    n: np.ndarray

    def near(self, ring: np.ndarray, lat: np.ndarray, lng: np.ndarray) -> Iterator[tuple[P.Ragged, np.ndarray]]:
        """Rings that are no rectangles, each flat around a place, and which of `ring` they are; not too many corners at a time."""
        other = np.flatnonzero(~self.upright[ring])
        last = np.cumsum(self.n)
        so_far = np.cumsum(self.n[ring[other]])
        for some in np.split(other, np.flatnonzero(np.diff(so_far // MOST_CORNERS)) + 1):
            if len(some):
                at, of = _spread((last - self.n)[ring[some]], last[ring[some]])
                y0, x0 = lat[some][of], lng[some][of]
                shapes = P.Ragged((self.lng[at] - x0) * (FLAT_M * np.cos(np.radians(y0))), (self.lat[at] - y0) * FLAT_M, self.n[ring[some]])
                yield shapes, some[shapes.which]


def hundredths(ha: np.ndarray) -> np.ndarray:
    """As round(ha, 2), in hundredths."""
    out = np.rint(ha * 100)
    for i in np.flatnonzero(np.abs(np.abs(ha * 100 - out) - 0.5) < 1e-6):
        out[i] = np.rint(round(float(ha[i]), 2) * 100)
    return out.astype(np.int64)


def _boxes(rings: Rings, ring, lat, lng) -> tuple[np.ndarray, ...]:
    """West, east, south and north of rings' boxes in metres from places."""
    k = FLAT_M * np.cos(np.radians(lat))
    return (rings.west[ring] - lng) * k, (rings.east[ring] - lng) * k, (rings.south[ring] - lat) * FLAT_M, (rings.north[ring] - lat) * FLAT_M


def metres(rings: Rings, ring: np.ndarray, lat: np.ndarray, lng: np.ndarray) -> np.ndarray:
    """From places to rings, 0 inside."""
    x0, x1, y0, y1 = _boxes(rings, ring, lat, lng)
    out = np.hypot(np.maximum(np.maximum(x0, -x1), 0), np.maximum(np.maximum(y0, -y1), 0))
    for shapes, some in rings.near(ring, lat, lng):
        out[some] = shapes.distances()
    return out


def hectares(rings: Rings, ring: np.ndarray, lat: np.ndarray, lng: np.ndarray, radius: float) -> np.ndarray:
    """Of rings inside the circles round places."""
    out = np.zeros(len(ring))
    plain = np.flatnonzero(rings.upright[ring])
    out[plain] = P.boxes_in_circle(*_boxes(rings, ring[plain], lat[plain], lng[plain]), radius)
    for shapes, some in rings.near(ring, lat, lng):
        out[some] = shapes.areas_in_circle(radius)
        for i in np.flatnonzero(~rings.simple[ring[some]]):
            p = slice(shapes.first[i], shapes.first[i] + shapes.n[i])
            out[some[i]] = P.union_area([np.column_stack([shapes.x[p], shapes.y[p]])], P.circle(radius))
    return out / 10_000


def largest(lat: np.ndarray, lng: np.ndarray, rings: Rings, radius: float, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(site, ring, pos from 1, hundredths of hectares): of each site the `most` rings with the largest shares of its circle,
    of 0.01 hectares or more; equal ones in the order of ids. A few sites at a time."""
    area = (rings.north - rings.south) * (rings.east - rings.west)  # square degrees: no share of a ring is larger
    top = max(float(area.max(initial=0.0)), 1e-300)
    order = np.argsort(-np.round(area / top * 1e9), kind="stable")  # what differs by rounding only stays in the order of ids
    strips = max(1, math.isqrt(len(lat) // AT_ONCE))
    strip = np.floor((lat - lat.min()) / max(float(np.ptp(lat)), 1e-12) * strips)
    sites = np.lexsort((lng, strip))
    for a in range(0, len(sites), AT_ONCE):
        some = sites[a : a + AT_ONCE]
        keys = _keys(lat[some], lng[some], rings, order, area, radius, most)
        site, pos = np.nonzero(keys >= 0)
        key = keys[site, pos]
        yield some[site], (1 << BITS) - 1 - (key & ((1 << BITS) - 1)), (pos + 1).astype(np.int32), key >> BITS


def _keys(lat, lng, rings: Rings, order, area, radius: float, most: int) -> np.ndarray:
    """Per site the largest keys, the largest first: hundredths of hectares, then what comes first in the order of ids; -1
    where there are no more."""
    k = FLAT_M * np.cos(np.radians(lat))
    reach_y, reach_x = radius / FLAT_M * (1 + 1e-9), radius / max(float(k.min()), 1e-6) * (1 + 1e-9)
    met = (rings.south[order] <= lat.max() + reach_y) & (rings.north[order] >= lat.min() - reach_y)
    met &= (rings.west[order] <= lng.max() + reach_x) & (rings.east[order] >= lng.min() - reach_x)
    order = order[met]
    rest = np.maximum.accumulate(area[order][::-1])[::-1]  # no ring from here on is larger
    found = np.full((len(lat), most), -1, np.int64)
    unit = k * FLAT_M / 10_000  # hectares of a square degree
    inner = (radius * math.cos(math.pi / P.SIDES)) ** 2
    # a bound in hundredths that rounding does not bring below the share's own
    bound = lambda ha: np.floor(np.minimum(ha, math.pi * radius**2 / 10_000) * (100 * (1 + 1e-9)) + (0.5 + 1e-6)).astype(np.int64)
    for a in range(0, len(order), AT_ONCE):
        ring = order[a : a + AT_ONCE]
        last = found.min(axis=1)  # what comes after it is not listed
        left = np.flatnonzero((bound(unit * rest[a]) + 1) << BITS > last)
        if not len(left):
            break
        y, x, kx = lat[left, None], lng[left, None], k[left, None]
        off_x = np.maximum(np.maximum(rings.west[ring] - x, x - rings.east[ring]), 0) * kx
        off_y = np.maximum(np.maximum(rings.south[ring] - y, y - rings.north[ring]), 0) * FLAT_M
        site, at = np.nonzero(off_x * off_x + off_y * off_y < radius * radius)
        site, at = left[site], ring[at]
        back = (1 << BITS) - 1 - at
        may = ((bound(unit[site] * area[at]) << BITS) | back) > last[site]
        site, at, back = site[may], at[may], back[may]
        x0, x1, y0, y1 = _boxes(rings, at, lat[site], lng[site])
        whole = rings.upright[at] & (np.maximum(x0 * x0, x1 * x1) + np.maximum(y0 * y0, y1 * y1) <= inner)
        ha = np.where(whole, unit[site] * area[at], 0.0)
        cut = np.clip(x1, -radius, radius) - np.clip(x0, -radius, radius), np.clip(y1, -radius, radius) - np.clip(y0, -radius, radius)
        rim = np.flatnonzero(~whole & (((bound(cut[0] * cut[1] / 10_000) << BITS) | back) > last[site]))
        ha[rim] = hectares(rings, at[rim], lat[site[rim]], lng[site[rim]], radius)
        held = np.flatnonzero(ha >= 0.01)
        site, key = site[held], (hundredths(ha[held]) << BITS) | back[held]
        if len(site):
            many = np.bincount(site, minlength=len(lat))
            more = np.full((len(lat), int(many.max())), -1, np.int64)
            more[site, np.arange(len(site)) - (np.cumsum(many) - many)[site]] = key
            found = np.partition(np.hstack([found, more]), more.shape[1], axis=1)[:, more.shape[1] :]
    return -np.sort(-found, axis=1)
