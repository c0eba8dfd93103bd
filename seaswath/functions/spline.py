"""Smoothing B-splines of a parametric curve in numpy, block by block.

Knots lie at points; spans of residuals above the average that s allows are halved until the sum of squared residuals is at
most s. Then the jumps of the highest derivative are penalised by 1 / p, where p is searched for until the sum comes
to s within a thousandth of it. Four points or fewer give a polynomial through all of them.

The coefficients solve a banded system, which is cut into pieces, and these into blocks of about SPANS spans. A block shares its first and
its last four coefficients with its neighbours: all blocks of a piece eliminate their others at once, neighbouring ones then join in pairs
until the piece's ends alone are left. These make a small system in a row, and each piece finishes by itself. Coefficients are held less the
points at their knots, so that sums stay small. `fit` does without blocks, for comparison.
"""

from __future__ import annotations

import numpy as np

TOLERANCE, DEGREE = 1e-3, 3
#: Spans of a block; every so many points a knot from the outset; logarithms of p that are tried first and last, and how many at once.
SPANS, FIRST, LOW, HIGH, TRIED = 32, 1024, -30.0, 60.0, 8
#: Coefficients that neighbouring blocks, and pieces, share.
BORDER = 4


def chord_parameter(points: np.ndarray) -> np.ndarray:
    """0 to 1 along the chords between successive points (n x dimensions)."""
    steps = np.sqrt((np.diff(points, axis=0) ** 2).sum(1))
    u = np.concatenate([[0.0], np.cumsum(steps)])
    return u / u[-1] if u[-1] > 0 else np.linspace(0, 1, len(points))


def basis(t: np.ndarray, k: int, u: np.ndarray) -> np.ndarray:
    """Dense design matrix: a row for each u, a column for each B-spline of degree k on knots t."""
    m = len(t) - k - 1
    span = np.clip(np.searchsorted(t, u, "right") - 1, k, m - 1)
    values = np.zeros((len(u), k + 1))
    values[:, 0] = 1.0
    for d in range(1, k + 1):
        last = np.zeros(len(u))
        for r in range(d):
            right, left = t[span + r + 1], t[span + r + 1 - d]
            share = values[:, r] / (right - left)
            values[:, r] = last + (right - u) * share
            last = (u - left) * share
        values[:, d] = last
    out = np.zeros((len(u), m))
    out[np.arange(len(u))[:, None], (span - k)[:, None] + np.arange(k + 1)] = values
    return out


def jumps(t: np.ndarray, k: int) -> np.ndarray:
    """Jumps of the k-th derivative at the inner knots as a matrix on the coefficients."""
    d = np.eye(len(t) - k - 1)
    for degree in range(k, 0, -1):  # each derivative has one knot less at either end
        held = t[k - degree : len(t) - (k - degree)]
        n = len(d) - 1
        d = degree * (d[1:] - d[:-1]) / (held[degree + 1 : degree + 1 + n] - held[1 : 1 + n])[:, None]
    return d[1:] - d[:-1]


def fit(u: np.ndarray, points: np.ndarray, s: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(knots, coefficients, degree) of the smoothing spline through points at u."""
    n, k = len(u), min(DEGREE, len(u) - 1)
    if n == 1:
        return np.array([0.0, 1.0]), points[:1], 0

    def knots(inner):
        return np.concatenate([np.full(k + 1, u[0]), inner, np.full(k + 1, u[-1])])

    def solved(t, p=None):
        b = basis(t, k, u)
        gram, right = b.T @ b, b.T @ points
        if p is not None:
            d = jumps(t, k)
            gram = gram + d.T @ d / p
        try:
            c = np.linalg.solve(gram, right)
        except np.linalg.LinAlgError:
            c = np.linalg.lstsq(gram, right, rcond=None)[0]
        each = ((points - b @ c) ** 2).sum(1)
        return c, each

    if s <= 0 and n > k:  # through every point
        inner = u[(k + 1) // 2 : n - (k + 1) // 2] if k % 2 else (u[k // 2 : n - k // 2 - 1] + u[k // 2 + 1 : n - k // 2]) / 2
        t = knots(inner)
        return t, np.linalg.solve(basis(t, k, u), points), k
    inner = np.zeros(0)
    c, each = solved(knots(inner))
    while each.sum() > s * (1 + TOLERANCE):
        at = np.searchsorted(u, inner)
        more = middles(np.append(0, at), np.append(at, n - 1), np.add.reduceat(each, np.append(0, at)), s / n, n)
        if not len(more):
            break
        inner = u[np.sort(np.concatenate([at, more]).astype(int))]
        c, each = solved(knots(inner))
    t = knots(inner)
    if each.sum() > s * (1 - TOLERANCE):
        return t, c, k
    low, high = LOW, HIGH
    while True:
        middle = (low + high) / 2
        c, each = solved(t, np.exp(middle))
        if abs(each.sum() - s) <= TOLERANCE * s or high - low < 1e-9:
            return t, c, k
        low, high = (middle, high) if each.sum() > s else (low, middle)


def evaluate(t: np.ndarray, c: np.ndarray, k: int, u: np.ndarray) -> np.ndarray:
    return np.repeat(c, len(u), 0) if k == 0 else basis(t, k, np.clip(u, t[0], t[-1])) @ c


def middles(first: np.ndarray, last: np.ndarray, residual: np.ndarray, share: float, n: int) -> np.ndarray:
    """New knots: the middle points of spans (from point `first` to `last`) with more residual than their share, where that may hold one."""
    at = first + (last - first) // 2
    return at[(residual > share * (last - first)) & (at > first) & (at >= 2) & (at <= n - 3)]


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solutions of many systems. Under a penalty so large that points are lost in rounding some are singular: these take their least solution."""
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        out = np.zeros((*a.shape[:-1], b.shape[-1]))
        for i in np.ndindex(a.shape[:-2]):
            try:
                out[i] = np.linalg.solve(a[i], b[i])
            except np.linalg.LinAlgError:
                out[i] = np.linalg.lstsq(a[i], b[i], rcond=None)[0]
        return out


class Piece:
    """Successive spans of a line: sums over their points, less the points at the knots, in blocks of about `spans` spans.

    t, v: the spans' knots and three more on each side, and the points at them; begins, last: whether the line begins or ends here. Points
    are in order, and each span has one at least. A piece shares its first and its last four coefficients with its neighbours; one
    that is not the last has four spans at least.
    """

    def __init__(self, begins: bool, last: bool, t: np.ndarray, v: np.ndarray, span: np.ndarray, u: np.ndarray, points: np.ndarray, spans: int = SPANS):
        self.begins, self.last, self.t, n = begins, last, t, len(t) - 7
        self.base = v[2 : 2 + n + (3 if last else BORDER)]
        values = local_basis(t, span, u)
        left = points - np.einsum("nr,nrd->nd", values, self.base[span[:, None] + np.arange(4)])
        starts = np.searchsorted(span, np.arange(n))
        self.gram, self.right = (np.add.reduceat(values[:, :, None] * x[:, None, :], starts) for x in (values, left))
        self.square = np.add.reduceat((left**2).sum(1), starts)
        self._assemble(spans)

    def _assemble(self, spans: int) -> None:
        """Blocks' matrices, all of a size: four coefficients that a block shares with the one before, its own, and four shared with the next."""
        n, count = len(self.gram), max(1, len(self.gram) // spans)
        edges = np.arange(count + 1) * n // count
        width = np.diff(edges)
        self.wide = max(BORDER, int(width.max()))
        self.of = np.repeat(np.arange(count), width)
        shift = self.wide - width
        if self.last:
            shift[-1] = 0  # nothing is shared there
        at = (np.arange(n) - edges[self.of])[:, None] + np.arange(5)
        self.place = at + np.where(at >= width[self.of][:, None], shift[self.of][:, None], 0)
        size = self.wide + BORDER
        self.h, self.g = np.zeros((count, size, size)), np.zeros((count, size, self.right.shape[2]))
        self.dd, self.dg = np.zeros_like(self.h), np.zeros_like(self.g)
        for i in range(4):
            self.g[self.of, self.place[:, i]] += self.right[:, i]
            for j in range(4):
                self.h[self.of, self.place[:, i], self.place[:, j]] += self.gram[:, i, j]
        rows = n - 1 if self.last else n  # an inner knot's jump belongs to the block of its first coefficient
        of, place, jump = self.of[:rows], self.place[:rows], local_jumps(self.t, rows)
        near = self.base[np.arange(rows)[:, None] + np.arange(5)]
        moved = np.einsum("ri,rid->rd", jump, near - near[:, 2:3])
        for i in range(5):
            self.dg[of, place[:, i]] += jump[:, i, None] * moved
            for j in range(5):
                self.dd[of, place[:, i], place[:, j]] += jump[:, i] * jump[:, j]
        free = (np.arange(size) >= width[:, None]) & (np.arange(size) < self.wide)
        if self.last:
            free[-1] = np.arange(size) >= width[-1] + 3
        block, k = np.nonzero(free)
        self.h[block, k, k] = 1.0  # no coefficient stands there

    def _reduced(self, p: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """How blocks' own coefficients follow from their ends, and ends between pairs of blocks from the outer ones; what is left at the piece's two ends."""
        w = (1.0 / p)[:, None, None, None]  # 0 where p is infinite
        h, g = self.h + w * self.dd, self.g - w * self.dg
        ends, own = np.r_[:BORDER, self.wide : self.wide + BORDER], np.arange(BORDER, self.wide)
        inner = solve(h[:, :, own[:, None], own], np.concatenate([h[:, :, own[:, None], ends], g[:, :, own]], 3))
        m, g = np.split(np.concatenate([h[:, :, ends[:, None], ends], g[:, :, ends]], 3) - h[:, :, ends[:, None], own] @ inner, [2 * BORDER], 3)
        pairs, one, two = [], slice(None, BORDER), slice(BORDER, None)
        while m.shape[1] > 1:
            even = m.shape[1] // 2 * 2
            a, b, f, e = m[:, :even:2], m[:, 1:even:2], g[:, :even:2], g[:, 1:even:2]
            x = solve(a[..., two, two] + b[..., one, one], np.concatenate([a[..., two, one], b[..., one, two], f[..., two, :] + e[..., one, :]], 3))
            across, outer = np.concatenate([a[..., one, two], b[..., two, one]], 2), np.zeros_like(a)
            outer[..., one, one], outer[..., two, two] = a[..., one, one], b[..., two, two]
            m = np.concatenate([outer - across @ x[..., : 2 * BORDER], m[:, even:]], 1)
            g = np.concatenate([np.concatenate([f[..., one, :], e[..., two, :]], 2) - across @ x[..., 2 * BORDER :], g[:, even:]], 1)
            pairs.append(x)
        return inner, pairs, m[:, 0], g[:, 0]

    def _ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Which of the coefficients at the two ends are shared, and which are the piece's own."""
        shared = np.repeat([not self.begins, not self.last], BORDER)
        return np.flatnonzero(shared), np.flatnonzero(~shared)

    def eliminated(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What a piece leaves on its border (for each p): a matrix and a right side."""
        _, _, m, g = self._reduced(p)
        b, i = self._ends()
        x = solve(m[:, i[:, None], i], np.concatenate([m[:, i[:, None], b], g[:, i]], 2))
        back = m[:, b[:, None], i] @ x
        return m[:, b[:, None], b] - back[:, :, : len(b)], g[:, b] - back[:, :, len(b) :]

    def finished(self, p: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(coefficients less base, squared residuals of each span), for each p, by the values at the border."""
        inner, pairs, m, g = self._reduced(p)
        b, i = self._ends()
        ends = np.zeros((len(p), 2 * BORDER, g.shape[2]))
        ends[:, b] = border
        ends[:, i] = solve(m[:, i[:, None], i], g[:, i] - m[:, i[:, None], b] @ border)
        ends = ends.reshape(len(p), 2, BORDER, -1)
        for x in pairs[::-1]:
            k = x.shape[1]
            now = np.zeros((len(p), ends.shape[1] + k, *ends.shape[2:]))
            now[:, : 2 * k + 1 : 2], now[:, 2 * k + 1 :] = ends[:, : k + 1], ends[:, k + 1 :]
            now[:, 1 : 2 * k : 2] = x[..., 2 * BORDER :] - x[..., : 2 * BORDER] @ np.concatenate([ends[:, :k], ends[:, 1 : k + 1]], 2)
            ends = now
        both = np.concatenate([ends[:, :-1], ends[:, 1:]], 2)
        blocks = np.concatenate([ends[:, :-1], inner[..., 2 * BORDER :] - inner[..., : 2 * BORDER] @ both, ends[:, 1:]], 2)
        c = blocks[:, self.of[:, None], self.place[:, :4]]
        squares = self.square - 2 * (c * self.right).sum((2, 3)) + np.einsum("psid,sij,psjd->ps", c, self.gram, c, optimize=True)
        rest = len(self.base) - len(self.gram)
        out = np.concatenate([c[:, :, 0], blocks[:, self.of[-1], self.place[-1, 1 : rest + 1]]], 1)
        return out, np.maximum(squares, 0.0)

    def taylor(self, c: np.ndarray, span: np.ndarray, u: np.ndarray) -> np.ndarray:
        """(points, dimensions, 4): the curve as a cubic in the distance from each u, by coefficients less base."""
        from_here = self.base[:1]
        c, out = c + (self.base - from_here), []
        for order in range(4):
            if order:
                k = DEGREE + 1 - order
                i = np.arange(len(c) - 1)
                wide = self.t[np.minimum(i + 4, len(self.t) - 1)] - self.t[i + order]
                c = k / order * np.diff(c, axis=0) / np.where(wide > 0, wide, np.inf)[:, None]
            values = local_basis(self.t, span, u, DEGREE - order)
            out.append(np.einsum("nr,nrd->nd", values, c[span[:, None] + np.arange(4 - order)]))
        out[0] = out[0] + from_here
        return np.stack(out, 2)


def local_basis(t: np.ndarray, span: np.ndarray, u: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """The degree + 1 B-splines of each u that are not 0; span j lies between t[j + 3] and t[j + 4]."""
    at = span + DEGREE
    values = np.zeros((len(u), degree + 1))
    values[:, 0] = 1.0
    for d in range(1, degree + 1):
        last = np.zeros(len(u))
        for r in range(d):
            right, left = t[at + r + 1], t[at + r + 1 - d]
            share = values[:, r] / (right - left)
            values[:, r] = last + (right - u) * share
            last = (u - left) * share
        values[:, d] = last
    return values


def local_jumps(t: np.ndarray, rows: int) -> np.ndarray:
    """(rows, 5): the jump of the third derivative at the knot t[row + 4] by five coefficients from `row` on."""
    w = np.ones((rows + 4, 1))
    for order in (1, 2, 3):
        n = len(w) - 1
        i = np.arange(n)
        factor = ((DEGREE + 1 - order) / (t[i + 4] - t[i + order]))[:, None]
        new = np.zeros((n, order + 1))
        new[:, 1:] += factor * w[1:]
        new[:, :-1] -= factor * w[:-1]
        w = new
    out = np.zeros((rows, 5))
    out[:, 1:] += w[1 : rows + 1]
    out[:, :-1] -= w[:rows]
    return out


def borders(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The values at each block's border, by what all blocks of a line leave on theirs (in order)."""
    if len(parts) == 1:
        return [parts[0][1]]  # no border at all
    kept, (m, h) = [], parts[0]
    for s, g in parts[1:]:
        m, h = m + s[:, :BORDER, :BORDER], h + g[:, :BORDER]
        across = s[:, :BORDER, BORDER:]
        solved = solve(m, np.concatenate([across, h], 2))
        kept.append((solved[:, :, : across.shape[2]], solved[:, :, across.shape[2] :]))
        if across.shape[2]:
            turned = across.transpose(0, 2, 1)
            m, h = s[:, BORDER:, BORDER:] - turned @ kept[-1][0], g[:, BORDER:] - turned @ kept[-1][1]
    values = [kept[-1][1]]
    for across, own in kept[-2::-1]:
        values.append(own - across @ values[-1])
    values = values[::-1]
    return [values[0], *(np.concatenate([a, b], 1) for a, b in zip(values, values[1:], strict=False)), values[-1]]


def condensed(parts: list[tuple[np.ndarray, np.ndarray]], begins: bool) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """What successive blocks leave together on their outer borders, and how each border between them follows from these; begins: whether the line does here."""
    at, kept, (m, h) = 0 if begins else BORDER, [], parts[0]
    for s, g in parts[1:]:
        across = np.concatenate([m[:, at:, :at], s[:, :BORDER, BORDER:]], 2)
        solved = solve(m[:, at:, at:] + s[:, :BORDER, :BORDER], np.concatenate([across, h[:, at:] + g[:, :BORDER]], 2))
        kept.append((solved[:, :, : across.shape[2]], solved[:, :, across.shape[2] :]))
        outer = np.zeros((len(m), across.shape[2], across.shape[2]))
        outer[:, :at, :at], outer[:, at:, at:] = m[:, :at, :at], s[:, BORDER:, BORDER:]
        turned = across.transpose(0, 2, 1)
        m, h = outer - turned @ kept[-1][0], np.concatenate([h[:, :at], g[:, BORDER:]], 1) - turned @ kept[-1][1]
    return m, h, kept


def within(kept: list[tuple[np.ndarray, np.ndarray]], begins: bool, border: np.ndarray) -> list[np.ndarray]:
    """The values at the border of each of successive blocks, by those at their outer borders."""
    at = 0 if begins else BORDER
    left, values = border[:, :at], [border[:, at:]]
    for across, own in kept[::-1]:
        values.append(own - across @ np.concatenate([left, values[-1]], 1))
    values = [left, *values[::-1]]
    return [np.concatenate([a, b], 1) for a, b in zip(values, values[1:], strict=False)]


def next_tries(low: float, high: float) -> np.ndarray:
    """Logarithms of p between two."""
    return low + (high - low) * np.arange(1, TRIED + 1) / (TRIED + 1)


def narrowed(low: float, high: float, sums: np.ndarray, s: float) -> tuple[float, float, float | None]:
    """The bounds round the p whose sum of squares is s, by the sums at the tries between them, and the p itself once found."""
    tries, sums = next_tries(low, high), np.where(np.isfinite(sums), sums, np.finfo(float).max)
    best = int(np.abs(sums - s).argmin())
    if abs(sums[best] - s) <= TOLERANCE * s or high - low < 1e-9:
        return low, high, float(tries[best])
    over = int((sums > s).sum())  # sums fall as p rises
    return (tries[over - 1] if over else low), (tries[over] if over < TRIED else high), None


def through_all(u: np.ndarray, points: np.ndarray) -> np.ndarray:
    """(points, dimensions, 4): the polynomial through up to four points, in the distance from each u."""
    out = np.zeros((len(u), points.shape[1], 4))
    for i, at in enumerate(u):
        out[i, :, : len(u)] = np.linalg.solve(np.vander(u - at, increasing=True), points - points[:1]).T
    out[:, :, 0] += points[0]
    return out


def curve(u: np.ndarray, points: np.ndarray, s: float, spans: int = SPANS) -> np.ndarray:
    """(points, dimensions, 4): the smoothing spline of a whole line as a cubic in the distance from each u."""
    n = len(u)
    if n <= DEGREE + 1:
        return through_all(u, points)

    def whole(at: np.ndarray) -> tuple[Piece, np.ndarray]:
        ends = [np.repeat(x[[0, -1]], BORDER, 0) for x in (u, points)]
        t, v = (np.concatenate([e[:BORDER], x[at], e[BORDER:]]) for e, x in zip(ends, (u, points), strict=True))
        span = np.searchsorted(at, np.arange(n), "right")
        return Piece(True, True, t, v, span, u, points, spans), span

    def solved(piece: Piece, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return piece.finished(p, np.zeros((len(p), 0, points.shape[1])))

    at = np.arange(2, n - 2) if s <= 0 else np.arange(FIRST, n - 2, FIRST)
    none = np.array([np.inf])
    while True:
        piece, span = whole(at)
        each = solved(piece, none)[1][0]
        more = middles(np.append(0, at), np.append(at, n - 1), each, s / n, n) if each.sum() > s * (1 + TOLERANCE) else []
        if not len(more):
            break
        at = np.sort(np.concatenate([at, more]))
    p = none
    if s > 0 and each.sum() < s * (1 - TOLERANCE):
        low, high, found = LOW, HIGH, None
        while found is None:
            tries = np.exp(next_tries(low, high))
            low, high, found = narrowed(low, high, solved(piece, tries)[1].sum(1), s)
        p = np.exp(np.array([found]))
    return piece.taylor(solved(piece, p)[0][0], span, u)
