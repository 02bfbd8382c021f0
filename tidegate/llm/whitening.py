"""Whitening of vectors along their leading principal components.

Three passes over the vectors, none of which moves a vector: exact sums, the covariance
of centred vectors, and the projection. A task adds up its vectors in numpy and hands on
one row per dimension or pair of dimensions, which Spark adds up. The covariance, whose
size depends on the dimensions alone, is decomposed on the driver:

1. Householder reflections bring it to tridiagonal form.
2. The number of sign changes in a Sturm sequence tells how many eigenvalues lie below
   a point; bisection on it encloses each leading eigenvalue.
3. Inverse iteration with the shifted tridiagonal matrix finds each eigenvector. Vectors
   of eigenvalues that lie close together are made orthogonal to those before them.
4. The reflections, applied in reverse, turn them into components of the covariance.

The components are small and go out with the tasks of the projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import fresh
from tidegate.llm.topk import usable

COMPONENTS = 8
SCALE, SHIFT = 1024.0, 100_000
# Neighbouring eigenvalues closer than this share of the largest make a cluster.
CLUSTER = 1e-3
# A component whose eigenvalue is under this share of the largest holds rounding only.
NOTHING = 1e-13
# Vectors that a task works on at a time, and the bytes of its numbers at most.
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 25


def tridiagonal(matrix):
    """``(diagonal, beside, reflections)`` of a symmetric matrix, by Householder reflections.

    ``reflections[k]`` is the unit normal of the k-th mirror, over coordinates ``k + 1`` on.
    """
    import numpy as np

    a = np.array(matrix, np.float64)
    size = len(a)
    normals = []
    for k in range(size - 2):
        below = a[k + 1 :, k]
        normal = below.copy()
        normal[0] += np.copysign(np.sqrt(below @ below), below[0])
        length = np.sqrt(normal @ normal)
        if length == 0:
            normals.append(np.zeros(size - k - 1))
            continue
        normal /= length
        rest = a[k + 1 :, k + 1 :]
        moved = rest @ normal
        moved -= (normal @ moved) * normal
        rest -= 2 * (np.outer(normal, moved) + np.outer(moved, normal))
        below -= 2 * (normal @ below) * normal
        a[k, k + 1 :] = below
        normals.append(normal)
    return np.diag(a).copy(), np.diag(a, 1).copy(), normals


def below(diagonal, beside, points):
    """How many eigenvalues are less than each point: negative terms of its Sturm sequence."""
    import numpy as np

    points = np.asarray(points, np.float64)
    tiny = np.finfo(np.float64).tiny / np.finfo(np.float64).eps
    term, count = np.ones_like(points), 0
    for d, b in zip(diagonal, np.append(0.0, beside)):
        term = d - points - b * b / term
        term = np.where(np.abs(term) < tiny, -tiny, term)
        count = count + (term < 0)
    return count


def leading_eigenvalues(diagonal, beside, wanted: int):
    """The greatest eigenvalues, falling, each bisected until doubles lie no closer."""
    import numpy as np

    size = len(diagonal)
    reach = np.abs(np.concatenate([[0.0], beside])) + np.abs(np.concatenate([beside, [0.0]]))
    margin = 1e-12 * max(np.abs(diagonal).max() + reach.max(), np.finfo(np.float64).tiny)
    low = np.full(wanted, (diagonal - reach).min() - margin)
    high = np.full(wanted, (diagonal + reach).max() + margin)
    rank = size - 1 - np.arange(wanted)  # so many eigenvalues are smaller
    while True:
        middle = 0.5 * (low + high)
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return high
        upper = below(diagonal, beside, middle) > rank
        high = np.where(open_ & upper, middle, high)
        low = np.where(open_ & ~upper, middle, low)


def _solved(diagonal, beside, right, least: float):
    """Solution of a tridiagonal system, by elimination with row exchanges; pivots are ``least`` at least."""
    import numpy as np

    size = len(diagonal)
    first, second, third = diagonal.copy(), np.append(beside, 0.0), np.zeros(size)
    under, x = beside.copy(), right.copy()
    for i in range(size - 1):
        if abs(under[i]) > abs(first[i]):
            first[i], under[i] = under[i], first[i]
            second[i], first[i + 1] = first[i + 1], second[i]
            if i + 2 < size:
                third[i], second[i + 1] = second[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        pivot = first[i] = first[i] or least
        share = under[i] / pivot
        first[i + 1] -= share * second[i]
        second[i + 1] -= share * third[i]
        x[i + 1] -= share * x[i]
    for i in range(size - 1, -1, -1):
        rest = x[i] - (second[i] * x[i + 1] if i + 1 < size else 0.0) - (third[i] * x[i + 2] if i + 2 < size else 0.0)
        x[i] = rest / (first[i] if abs(first[i]) > least else np.copysign(least, first[i]))
        if abs(x[i]) > 1e150:
            x *= 1e-150
    return x


def eigenvectors(diagonal, beside, values, steps: int = 4):
    """Unit eigenvectors of a tridiagonal matrix, as rows, by inverse iteration from its eigenvalues."""
    import numpy as np

    size = len(diagonal)
    largest = max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0), np.abs(values).max(initial=0.0))
    least = np.finfo(np.float64).eps * (largest or 1.0)
    draw = np.random.default_rng(1)
    found = np.zeros((len(values), size))
    first = 0  # of the cluster
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * largest:
            first = k
        # equal shifts would lead to equal vectors, so members of a cluster are told apart a little
        shift = value - (k - first) * 4 * np.finfo(np.float64).eps * largest
        vector = draw.normal(size=size)
        for _ in range(steps):
            for _ in range(2):  # what one subtraction leaves over, the second removes
                vector = vector - found[first:k].T @ (found[first:k] @ vector)
                vector /= np.sqrt(vector @ vector)
            vector = _solved(diagonal - shift, beside, vector, least)
            vector /= np.abs(vector).max()
        for _ in range(2):
            vector = vector - found[first:k].T @ (found[first:k] @ vector)
            vector /= np.sqrt(vector @ vector)
        found[k] = vector
    return found


def leading_components(covariance, wanted: int):
    """``(eigenvalues, components)`` of a symmetric matrix, the greatest first; components are rows."""
    import numpy as np

    size = len(covariance)
    wanted = min(wanted, size)
    scale = np.abs(covariance).max(initial=0.0)
    if not scale:
        return np.zeros(wanted), np.eye(size)[:wanted]
    diagonal, beside, normals = tridiagonal(np.asarray(covariance) / scale)
    values = leading_eigenvalues(diagonal, beside, wanted)
    vectors = eigenvectors(diagonal, beside, values)
    for k in range(len(normals) - 1, -1, -1):
        vectors[:, k + 1 :] -= 2 * np.outer(vectors[:, k + 1 :] @ normals[k], normals[k])
    return values * scale, vectors


def _numbered(vectors, size: int):
    """Vectors of an Arrow batch as whole numbers, a part of the rows at a time: ``(first row, x)``."""
    import numpy as np

    sizes = np.diff(np.asarray(vectors.offsets, np.int64))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, size))))
    for at in range(0, len(sizes), rows):
        own = sizes[at : at + rows]
        values = np.zeros((len(own), size))
        values[np.arange(size) < own[:, None]] = flat[ends[at] - sizes[at] : ends[at + len(own) - 1]]
        yield at, np.floor(values * SCALE).astype(np.int64) + SHIFT


def _entries(numbers, names):
    """One batch of ``names[:-1]`` as places of an array, and its values."""
    import numpy as np
    import pyarrow as pa

    places = np.indices(numbers.shape).reshape(numbers.ndim, -1)
    return pa.RecordBatch.from_arrays([*(pa.array(p.astype(np.int32)) for p in places), pa.array(numbers.reshape(-1))], list(names))


def _sums(size: int):
    """Per task, the sum of the whole numbers of each dimension; row ``size`` counts vectors."""

    def run(batches):
        import numpy as np

        sums = np.zeros(size + 1, np.int64)
        for batch in batches:
            for _, x in _numbered(batch.column("vector"), size):
                sums[:size] += x.sum(axis=0)
                sums[size] += len(x)
        yield _entries(sums, ("i", "value"))

    return run


def _products(size: int, centre, project=None):
    """Per task, the sum of centred products of each two columns."""

    def run(batches):
        import numpy as np

        width = size if project is None else len(project)
        sums = np.zeros((width, width))
        for batch in batches:
            for _, x in _numbered(batch.column("vector"), size):
                y = x - centre
                if project is not None:
                    y = y @ project.T
                sums += y.T @ y
        yield _entries(sums, ("i", "j", "value"))

    return run


def _projected(size: int, n: int, total, centre, project, explained, error, others):
    """Every row once per component."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        width = len(project)
        for batch in batches:
            for at, x in _numbered(batch.column("vector"), size):
                off = n * x - total
                if np.abs(off).max(initial=0) ** 2.0 * max(1, size) < 2**62:
                    deviation = pa.array((off**2).sum(axis=1))
                else:  # whole numbers of any length; beyond 64 bits there is no answer
                    whole = [sum(v * v for v in row) for row in off.tolist()]
                    deviation = pa.array([v if v < 2**63 else None for v in whole], pa.int64())
                whitened = (x - centre) @ project.T
                rows = pa.array(np.repeat(np.arange(len(x)), width))
                part = batch.slice(at, len(x))
                none = np.tile(~np.isfinite(explained) | (np.abs(project).max(axis=1) == 0), len(x))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(rows) for c in others),
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(rows), n)),
                        deviation.take(rows),
                        pa.array(whitened.reshape(-1), mask=none),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(len(rows), error)),
                    ],
                    [*others, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def _gathered(parts: DataFrame, shape: tuple, kind):
    """The tasks' sums added up, as an array; one row per place, however many tasks there were."""
    import numpy as np

    places = [c for c in ("i", "j") if c in parts.columns]
    found = parts.groupBy(*places).agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(shape, kind)
    out[tuple(found[c].to_numpy() for c in places)] = found["value"].to_numpy()
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``<id_col>, component, n, deviation, whitened, explained, identity_error`` per row and component.

    An entry ``c`` counts as ``floor(1024 * c) + 100000``. Rows whose vector is null, or
    holds a null or non-finite entry, are left out; all others are fitted on and returned,
    also those with a null id, and rows that repeat are each counted and returned. There
    are as many components as asked for, or as dimensions if fewer. Vectors of unlike
    length count as if the shorter ended in entries 0; vectors without any entry give no
    rows if all are so. ``deviation`` is null beyond 64 bits. A component without variance
    has a null ``whitened`` and takes no part in ``identity_error``; if no vector differs
    from another that holds for all, and ``explained`` is 0. Equal eigenvalues may give any
    orthogonal components of their space. An empty table gives an empty result. Columns of
    other names do not matter.
    """
    import numpy as np

    name = fresh(vectors.select(F.col(id_col)), "vector")
    sound = vectors.select(F.col(id_col), F.col(vector_col).cast("array<double>").alias(name)).filter(usable(name))
    sound = sound.withColumnRenamed(name, "vector") if name != "vector" else sound
    size = sound.agg(F.max(F.size("vector"))).first()[0] or 0
    made = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    kind = sound.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {made}"
    if not size:
        return vectors.sparkSession.createDataFrame([], schema)
    only = sound.select("vector")
    sums = _gathered(only.mapInArrow(_sums(size), "i int, value long"), (size + 1,), np.int64)
    total, n = sums[:size], int(sums[size])
    centre = total // n + (total % n) / n  # whole part and rest, so that no digit of large sums is lost
    covariance = _gathered(only.mapInArrow(_products(size, centre), "i int, j int, value double"), (size, size), np.float64) / n
    covariance = (covariance + covariance.T) / 2
    values, found = leading_components(covariance, components)
    trace = float(np.trace(covariance))
    some = values > NOTHING * max(values.max(initial=0.0), 0.0)
    explained = np.clip(values, 0.0, None) / trace if trace > 0 else np.zeros(len(values))
    project = np.where(some[:, None], found / np.sqrt(np.where(some, values, 1.0))[:, None], 0.0)
    error = 0.0
    if some.any():
        shape = (len(project),) * 2
        again = _gathered(only.mapInArrow(_products(size, centre, project), "i int, j int, value double"), shape, np.float64) / n
        error = float(np.abs(again - np.diag(some.astype(float))).max())
    return sound.mapInArrow(_projected(size, n, total, centre, project, explained, error, [id_col]), schema)
