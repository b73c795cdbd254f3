"""Whitening of embeddings by eigenvectors that are refined in mixed precision.

Components are read as whole numbers, so sums and products are exact however they are dealt: every
task multiplies its rows, centred at the whole part of the mean, and Spark adds the products up.
The covariance is as wide as a vector is long, whatever the number of rows. Its eigenvectors are
found in float32 and then corrected in extended precision by the iteration of Ogita and Aishima,
which only multiplies matrices and doubles the right digits each time. Where eigenvalues are too
close for it, the vectors of such a cluster span the right space and only have to be turned in it:
the covariance is shifted by their mean, taken down to that space, solved there, and the iteration
goes on. A last pass projects every row and measures the covariance of what came out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import lean, written

#: Components returned.
COMPONENTS = 32
#: Rows in one product, and bits of a part of a number: products of a block are exact in doubles.
ROWS, PART = 1 << 16, 18
#: Whole numbers from here on may have lost digits as doubles.
LARGEST = 2.0**53
#: Corrections of the eigenvectors at most, and the share of the largest eigenvalue that counts as none.
ROUNDS, NONE = 60, 1e-14

Precise = np.longdouble


def whole(vectors: DataFrame, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """vec_id and ``x = floor(scale * c) + shift`` of every entry, for vectors that can take part."""
    c = F.col("embedding")
    usable = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * scale < LARGEST))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(c, lambda v: F.floor(v.cast("double") * scale).cast("long") + F.lit(shift).cast("long")).alias("x")
    )


def matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def parts(y: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as sums of ``part * 2 ** (PART * place)``, parts small enough for exact products."""
    out = []
    while np.abs(y).max(initial=0) >= 1 << PART:
        out.append((y & ((1 << PART) - 1)).astype(float))
        y = y >> PART
    return [*out, y.astype(float)]


def exact_sums(rows: DataFrame, centre: list[int], products: bool) -> list[list[int]]:
    """Sums of the entries less ``centre`` as first row; with ``products``, sums of their products as the rows below."""
    shared = rows.sparkSession.sparkContext.broadcast(np.array(centre, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = parts(matrix(batch.column(0).slice(at, ROWS)) - shared.value)
                for i, left in enumerate(y):
                    rows = np.hstack([np.full((len(left), 1), float(i == 0)), left]) if products else np.full((len(left), 1), float(i == 0))
                    for j, right in enumerate(y):
                        # Exact: below 2^53 in doubles; whole numbers of 64 bits hold the sums of a task.
                        if i == 0 or products:
                            sums[i + j] = sums.get(i + j, 0) + (rows.T @ right).astype(np.int64)
        for place, found in sums.items():
            size = len(found)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, place, np.int32)), pa.array(np.arange(size, dtype=np.int32)), lists], ["place", "i", "sums"])

    met = rows.select("x").mapInArrow(lean(run), "place int, i int, sums array<long>")
    cells = met.select("place", "i", F.posexplode("sums").alias("j", "s")).groupBy("place", "i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = [[0] * len(centre) for _ in range(1 + len(centre) * products)]
    # As many numbers as a covariance has, however many rows there are.
    for cell in cells.toLocalIterator():
        out[cell.i][cell.j] += int(cell.s) << (PART * cell.place)
    return out


def precise(numbers: list[list[int]]) -> np.ndarray:
    """Whole numbers of any size in extended precision."""
    high = [[float(x) for x in row] for row in numbers]
    low = [[float(x - int(h)) for x, h in zip(row, own, strict=True)] for row, own in zip(numbers, high, strict=True)]
    return np.array(high, Precise) + np.array(low, Precise)


def clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Places of eigenvalues that lie in chains of steps of at most ``near``."""
    order = np.argsort(values)
    cuts = np.nonzero(np.diff(values[order]) > near)[0] + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def upright(x: np.ndarray) -> np.ndarray:
    """Columns that are nearly of unit length and at right angles, made so to the last digit."""
    for _ in range(2):
        x = x + x @ (np.eye(x.shape[1], dtype=Precise) - x.T @ x) / 2
    return x


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and unit eigenvectors of a symmetric matrix in extended precision."""
    size = np.abs(a).max()
    if not size:
        return np.zeros(len(a), Precise), np.eye(len(a), dtype=Precise)
    a = a / size
    norm, one = np.linalg.norm(a.astype(float)), np.eye(len(a), dtype=Precise)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(Precise)
    least = 8 * len(a) * float(np.finfo(Precise).eps)
    for _ in range(ROUNDS):
        r, s = one - x.T @ x, x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        # What vectors still hold of each other; symmetric, so that turning them leaves their angles.
        mixed = (s + s.T) / 2 + (values[None, :] + values[:, None]) / 2 * r
        np.fill_diagonal(mixed, 0)
        if max(np.abs(mixed).max() / norm, np.abs(r).max()) < least:
            break
        near = 4 * max(least * norm, float(np.linalg.norm(mixed.astype(float))), float(np.linalg.norm(r.astype(float))) * norm)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > near
        # All are made of unit length and at right angles; turned only where they can be told apart.
        x = x + x @ (r / 2 + np.where(apart, mixed / np.where(apart, gap, 1), 0))
        for group in clusters(values, near):
            if np.abs(mixed[np.ix_(group, group)]).max() > least * norm / 2:
                basis = x[:, group]
                inner = basis.T @ (a @ basis - values[group].mean() * basis)
                turn = np.linalg.eigh(((inner + inner.T) / np.abs(inner).max()).astype(float))[1].astype(Precise)
                x[:, group] = basis @ upright(turn)
    x = upright(x)
    x = x / np.sqrt((x * x).sum(0))
    values = (x * (a @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """Every row's whitened components: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries c are read as ``floor(scale * c) + shift``. ``n`` rows have the sums S and a covariance with
    divisor n. ``deviation`` is the sum of (n x - S)^2 over the row, exact; missing where it needs over
    64 bits. ``whitened`` is x - S/n projected on a unit eigenvector over the root of its eigenvalue,
    eigenvalues falling from component 1; ``explained`` its share of all. ``identity_error`` is the
    largest distance of the covariance of ``whitened``, measured on what came out, from the identity.

    Vectors that are missing, empty, or hold a missing or non-finite entry do not take part, nor do
    entries whose ``scale * c`` is 2^53 or more, which have no exact whole number. Where lengths
    differ, those of the commonest length are whitened (of equally common ones the longest); others
    have no rows. Repeated rows and rows without vec_id are rows like others. A component without
    variance (fewer rows than entries, constant entries) has no ``whitened``. Equal eigenvalues leave
    their vectors free to turn among each other. Empty tables give no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    usable = whole(vectors, scale, shift)
    sizes = usable.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if sizes is None:
        return spark.createDataFrame([], OUT)
    width, n = int(sizes["width"]), int(sizes["count"])
    rows = usable.where(F.size("x") == width)

    centre = [shift] * width
    total = [s + n * shift for s in exact_sums(rows, centre, products=False)[0]]
    centre = [s // n for s in total]
    sums, *products = exact_sums(rows, centre, products=True)
    # n^2 times the covariance, exact: the centre is less than one away from the mean.
    covariance = [[n * p - sums[i] * sums[j] for j, p in enumerate(row)] for i, row in enumerate(products)]
    values, x = spectrum(precise(covariance))
    values, x = values[:components], x[:, :components]
    known = values > NONE * (values[0] or 1)
    trace = float(sum(covariance[i][i] for i in range(width)))
    explained = [float(v) / trace if trace else None for v in np.maximum(values, 0)]
    # (n x - S) times this is whitened: the vectors over the roots of n^2 times their eigenvalues.
    project = np.where(known, x / np.sqrt(np.where(known, values, 1)), 0).astype(float)
    shared = spark.sparkContext.broadcast((np.array(centre, np.int64), np.array(sums, object), project, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, sums, project, known = shared.value
        for batch in batches:
            y = matrix(batch.column(1)) - centre
            if int(np.abs(y).max(initial=0) + 1) * n < 2**62:
                far = y * n - sums.astype(np.int64)
            else:
                far = y.astype(object) * n - sums
            most = max((abs(int(far.min(initial=0))), abs(int(far.max(initial=0)))))
            if most**2 * width < 2**63:
                deviation = pa.array((far * far).sum(1).astype(np.int64))
            else:
                squares = [sum(int(f) ** 2 for f in row) for row in far]
                deviation = pa.array([s if s < 2**63 else None for s in squares], pa.int64())
            out = far.astype(float) @ project
            flat = pa.array(out.ravel(), mask=np.tile(~known, len(out)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * len(known), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], ["vec_id", "deviation", "whitened"])

    found = written(rows.select("vec_id", "x").mapInArrow(lean(run), "vec_id long, deviation long, whitened array<double>"), "whitened")
    error = identity_error(found, int(known.sum()), n)
    pick = [F.element_at(F.array(*[F.lit(e).cast("double") for e in explained]), F.col("component")).alias("explained")]
    long = found.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).withColumn("component", F.col("place") + 1)
    return long.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", *pick, F.lit(error).cast("double").alias("identity_error"))


def identity_error(found: DataFrame, known: int, n: int) -> float | None:
    """Largest distance of the covariance of the first ``known`` whitened components from the identity."""
    if not known:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((known + 1, known))
        for batch in batches:
            w = matrix(batch.column(0))[:, :known]
            sums += np.hstack([np.ones((len(w), 1)), w]).T @ w
        i, j = np.indices(sums.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(sums.ravel())], ["i", "j", "s"])

    met = found.select("whitened").mapInArrow(lean(run), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    sums = np.zeros((known + 1, known))
    for cell in met.toLocalIterator():
        sums[cell.i, cell.j] = cell.s
    mean = sums[0] / n
    return float(np.abs(sums[1:] / n - np.outer(mean, mean) - np.eye(known)).max())
