"""Tricube-weighted local lines over a sorted series, in constant time per row.

The tricube weight is a polynomial of degree nine in the distance on each side of a row, so
the sums a local line needs are sums of powers of the distance. Running sums of powers,
centred and scaled per block of rows, give the sums of any part of a block; a window of the
k nearest rows covers a few blocks, whatever k is. Centres lie within a window's width of
the row, so that shifting the powers to the row costs no precision.
"""

from __future__ import annotations

import numpy as np

#: Powers needed of the distance, without and with the value.
_POWERS, _VALUE_POWERS = 12, 11
#: Windows of up to so many rows are summed directly.
_DIRECT = 64


def nearest_rows(x: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """First of the k rows nearest to each of ``rows`` in sorted ``x``; ties go to the smaller x."""
    low, high = np.maximum(rows - k + 1, 0), np.minimum(rows, len(x) - k)
    while (low < high).any():
        middle = (low + high) // 2
        fits = x[rows] - x[middle] <= x[np.minimum(middle + k, len(x) - 1)] - x[rows]
        open_ = low < high
        high = np.where(open_ & fits, middle, high)
        low = np.where(open_ & ~fits, middle + 1, low)
    return low


def _weights(u: np.ndarray) -> np.ndarray:
    return np.where(u <= 0.001, 1.0, np.where(u > 0.999, 0.0, (1 - u * u * u) ** 3))


def _sums_direct(x: np.ndarray, y: np.ndarray, r: np.ndarray, own: np.ndarray, radius: np.ndarray,
                 start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """s0, s1, s2, t0, t1 of each row over rows start..stop, in units of the radius."""
    out = np.zeros((5, len(own)))
    for step in range(int((stop - start).max(initial=0))):
        at = np.minimum(start + step, len(x) - 1)
        v = np.divide(x[at] - own, radius, out=np.zeros(len(own)), where=radius > 0)
        w = np.where(start + step < stop, r[at] * _weights(np.abs(v)), 0.0)
        out += np.stack([w, w * v, w * v * v, w * y[at], w * v * y[at]])
    return out


class _Moments:
    """Running sums of powers within blocks of ``width`` rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, r: np.ndarray, width: int):
        self.x, self.y, self.r, self.width = x, y, r, width
        starts = np.arange(0, len(x), width)
        low, high = x[starts], x[np.minimum(starts + width, len(x)) - 1]
        self.centre, self.scale = low / 2 + high / 2, np.maximum(high / 2 - low / 2, 1e-300)
        block = np.arange(len(x)) // width
        z = (x - self.centre[block]) / self.scale[block]
        power, self.plain, self.valued = r.copy(), [], []
        for e in range(_POWERS):
            self.plain.append(self._running(power, starts))
            if e < _VALUE_POWERS:
                self.valued.append(self._running(power * y, starts))
            power = power * z

    def _running(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sum of the rows before each row within its block, and of whole blocks in a last column."""
        whole = np.zeros(len(starts) * self.width)
        whole[:len(values)] = values
        sums = np.cumsum(whole.reshape(-1, self.width), axis=1)
        return np.concatenate([np.zeros((len(starts), 1)), sums], axis=1)

    def powers(self, own: np.ndarray, radius: np.ndarray, block: np.ndarray, start: np.ndarray,
               stop: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Sums of v^e and y v^e over rows start..stop of a block, v: distance in units of the radius."""
        first, last = start - block * self.width, stop - block * self.width
        shift, ratio = (self.centre[block] - own) / radius, self.scale[block] / radius
        out = []
        for table in (self.plain, self.valued):
            sums, power = [], np.ones(len(own))
            for prefix in table:
                sums.append((prefix[block, last] - prefix[block, first]) * power)
                power = power * ratio
            for done in range(1, len(sums)):
                for e in range(len(sums) - 1, done - 1, -1):
                    sums[e] = sums[e] + shift * sums[e - 1]
            out.append(sums)
        return out[0], out[1]

    def add(self, total: np.ndarray, own: np.ndarray, radius: np.ndarray, start: np.ndarray, stop: np.ndarray,
            side: int) -> None:
        """Adds to ``total`` the weighted sums over rows start..stop: left (1), right (-1) or all alike (0)."""
        for step in range(int(((stop - 1) // self.width - start // self.width).max(initial=-1)) + 1):
            block = np.minimum(start // self.width + step, len(self.centre) - 1)
            a, b = np.maximum(start, block * self.width), np.minimum(stop, (block + 1) * self.width)
            here = np.flatnonzero((start // self.width + step == block) & (a < b))
            # A block much wider than the window would cost precision: its few rows are summed directly.
            wide = self.scale[block[here]] > 2 * radius[here]
            odd, here = here[wide], here[~wide]
            if len(odd):
                total[:, odd] += _sums_direct(self.x, self.y, self.r, own[odd], radius[odd], a[odd], b[odd])
            if not len(here):
                continue
            p, q = self.powers(own[here], radius[here], block[here], a[here], b[here])
            for row, (sums, e) in enumerate(((p, 0), (p, 1), (p, 2), (q, 0), (q, 1))):
                part = sums[e]
                if side:
                    part = part + 3 * side * sums[e + 3] + 3 * sums[e + 6] + side * sums[e + 9]
                total[row, here] += part


def local_lines(x: np.ndarray, y: np.ndarray, r: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Value at each of ``rows`` of the line through its k nearest rows of sorted ``x``.

    Weights are ``r`` times the tricube of the distance (1 up to a thousandth of the
    farthest one, 0 in its last thousandth). Without any weight the value is ``y``.
    """
    own = x[rows]
    if k < 1:
        return y[rows].copy()
    start = nearest_rows(x, rows, k)
    stop = start + k
    radius = np.maximum(own - x[start], x[stop - 1] - own)
    if k <= _DIRECT:
        s0, s1, s2, t0, t1 = _sums_direct(x, y, r, own, radius, start, stop)
    else:
        total = np.zeros((5, len(rows)))
        flat = radius == 0
        total[:, flat] = _sums_direct(x, y, r, own[flat], radius[flat], start[flat], stop[flat])
        moments = _Moments(x, y, r, max(k // 4, 16))
        far = np.flatnonzero(~flat)
        own_, radius_, start_, stop_ = own[far], radius[far], start[far], stop[far]
        def edge(part: float, side: str) -> np.ndarray:
            return np.clip(np.searchsorted(x, own_ + part * radius_, side), start_, stop_)
        bounds = [edge(-0.999, "left"), edge(-0.001, "left"), edge(0.001, "right"), edge(0.999, "right")]
        sums = np.zeros((5, len(far)))
        for a, b, side in zip(bounds, bounds[1:], (1, 0, -1)):
            moments.add(sums, own_, radius_, a, b, side)
        total[:, far] = sums
        s0, s1, s2, t0, t1 = total
    spread = s0 * s2 - s1 * s1
    level = np.divide(s2 * t0 - s1 * t1, spread, out=np.full(len(rows), np.nan),
                      where=np.abs(spread) > 1e-12 * s0 * s2)
    mean = np.divide(t0, s0, out=np.full(len(rows), np.nan), where=s0 > 0)
    return np.where(s0 > 0, np.where(np.isnan(level), mean, level), y[rows])
