"""Whitening of embeddings by shifted CholeskyQR.

Entries are counted in steps of 1 / ``STEPS`` (rounded down), so sums and deviations are exact whole numbers.  The
fit list is each distinct vector once.  Its centred rows Y are orthogonalised: a pass over the rows sums up the Gram
matrix of ``Y inv(R)`` inside each task (the factors found so far are solved for, nothing is stored), the driver takes
its Cholesky factor, and the product R of all factors is kept.  The first factor is shifted by a bound of the rounding
errors, so it exists for any data, the next two make the rows orthonormal up to rounding.  Y = Q R; the last pass
measures Q'Q, whose root times R has the same singular values and right vectors as Y even where columns depend on
each other.  Its SVD gives the components, and a Gram pass over the whitened fit list what is left of the identity.

A task sends sums and one matrix, however many rows it has; a matrix is all that comes to the driver or is
broadcast, and its size is that of one vector squared.

Cases: vectors that are null or hold null, NaN or infinite entries, or entries beyond ``MOST`` steps, are left out;
so are vectors of another length than most distinct ones have (of equally common lengths the greatest is taken) and
empty ones; repeated rows count once in the fit and are all returned; null ids are allowed; components without variance do not
exist, so fewer than ``most`` come back where distinct vectors or independent columns are few, and none for an empty
table or one distinct vector; a deviation that no long holds is null; other columns are not part of the result.
"""

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.sources.workspace import stored

STEPS = 256
COMPONENTS = 4
#: Whole numbers below this are exact as doubles.
MOST = 2**53
#: A direction whose singular value is this small beside the largest is rounding, not variance.
LEAST_SHARE = 1e-10
#: Rows that are worked on at once.
ROWS = 8192


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, size and packed steps (64-bit) of the vectors that take part."""
    for batch in batches:
        vectors = batch.column(1)
        sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = vectors.flatten()
        ends = np.cumsum(sizes)
        values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            steps = np.floor(values * STEPS)
            bad = np.concatenate(([0], np.cumsum(~(np.abs(steps) < MOST))))
        good = np.flatnonzero((sizes > 0) & (bad[ends] == bad[ends - sizes]))
        packed = np.where(np.isfinite(steps), steps, 0).clip(-MOST, MOST).astype("<i8")
        rows = [packed[e - n : e].tobytes() for e, n in zip(ends[good].tolist(), sizes[good].tolist(), strict=True)]
        columns = [batch.column(0).take(pa.array(good)), pa.array(sizes[good]), pa.array(rows, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "size", "x"])


def steps(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, size and x (packed steps) of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col(column).cast("array<double>"))
    return rows.mapInArrow(_counted, "vec_id long, size long, x binary")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            rows = batch.column("x").slice(at, ROWS).to_pylist()
            yield np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), -1)


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low, high, largest = None, None, None
    for x in _matrices(batches):
        # Two halves of each number, so that no sum overflows.
        sums = ((x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0), np.abs(x).max(axis=0))
        low, high, largest = sums if low is None else (low + sums[0], high + sums[1], np.maximum(largest, sums[2]))
    if low is not None:
        columns = [pa.array(c) for c in (np.arange(len(low)), low, high, largest)]
        yield pa.RecordBatch.from_arrays(columns, ["place", "low", "high", "largest"])


class Centre:
    """Rows minus their mean: ``n * x - sums`` exactly, then over n."""

    def __init__(self, n: int, sums: list[int], largest: int) -> None:
        self.n, self.wide = n, n * largest + max(map(abs, sums), default=0) >= 2**62
        self.sums = np.array(sums, object if self.wide else np.int64)

    def exact(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(object) if self.wide else x) * self.n - self.sums

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (self.exact(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of ``n * x - sums``; None where no long holds it."""
        exact = self.exact(x)
        largest = int(np.abs(exact).max(initial=0))
        if largest**2 * x.shape[1] < 2**63:
            return (exact * exact).sum(axis=1).tolist()
        found = [sum(int(v) ** 2 for v in row) for row in exact]
        return [v if v < 2**63 else None for v in found]


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows @ inv(factor)`` for an upper triangular factor, column after column."""
    out = rows.copy()
    for j in range(factor.shape[0]):
        out[:, j] = (out[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _gram(fit: DataFrame, centre: Centre, factors: list[np.ndarray], size: int, onto: np.ndarray | None = None) -> np.ndarray:
    """Gram matrix of the centred rows after solving for ``factors`` (or of their products with ``onto``)."""
    shared = fit.sparkSession.sparkContext.broadcast((vars(centre), factors, onto))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, own_factors, own_onto = shared.value
        own = Centre.__new__(Centre)
        vars(own).update(values)
        total = None
        for x in _matrices(batches):
            rows = own.rows(x)
            for factor in own_factors:
                rows = solved(rows, factor)
            rows = rows if own_onto is None else rows @ own_onto
            total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            place = np.arange(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(list(total), pa.list_(pa.float64()))], ["row", "sums"])

    parts = fit.select("x").mapInArrow(summed, "row long, sums array<double>")
    cells = parts.select("row", F.posexplode("sums").alias("column", "value")).groupBy("row", "column").agg(F.sum("value").alias("value"))
    out = np.zeros((size, size))
    for r in cells.collect():
        out[r["row"], r["column"]] = r["value"]
    return (out + out.T) / 2


def _cholesky(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper factor; with a shift that bounds rounding errors, doubled until the factor exists."""
    size = len(gram)
    unit = 11 * (n * size + size * (size + 1)) * np.finfo(float).eps / 2
    shift = min(unit, 1e-3) * float(np.linalg.norm(gram, 2))
    for turn in range(60):
        add = 0.0 if turn == 0 and not shifted else shift * 2.0 ** max(turn - 1, 0)
        try:
            return np.linalg.cholesky(gram + add * np.eye(size)).T
        except np.linalg.LinAlgError:
            continue
    raise ArithmeticError("no Cholesky factor")


class Whitening:
    """``centre``; unit ``components`` (columns), their ``variances`` by size, and the whole variance (``trace``)."""

    def __init__(self, centre: Centre, components: np.ndarray, variances: np.ndarray, trace: float) -> None:
        self.centre, self.components, self.variances, self.trace = centre, components, variances, trace

    @property
    def projection(self) -> np.ndarray:
        return self.components / np.sqrt(self.variances)


def fit_list(rows: DataFrame) -> tuple[DataFrame, int]:
    """The distinct vectors among ``steps`` rows that have the commonest length (stored), and that length."""
    distinct = stored(rows.select("size", "x").distinct(), "distinct-vectors")
    common = distinct.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0
    return distinct.filter(F.col("size") == size), size


def fit(distinct: DataFrame, size: int, most: int = COMPONENTS) -> Whitening | None:
    """The first ``most`` components of a fit list; None where nothing varies."""
    n = distinct.count()
    if n < 2:
        return None
    parts = distinct.select("x").mapInArrow(_column_sums, "place long, low long, high long, largest long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high")]
    sums = parts.groupBy("place").agg(*exact, F.max("largest").alias("largest")).orderBy("place").collect()
    whole = [int(r["high"] * Decimal(2**32) + r["low"]) for r in sums]
    centre = Centre(n, whole, max(int(r["largest"]) for r in sums))
    gram = _gram(distinct, centre, [], size)
    trace = float(np.trace(gram)) / n
    if not trace > 0:
        return None
    factors: list[np.ndarray] = []
    for turn in range(3):
        factors.append(_cholesky(gram, n, shifted=turn == 0))
        gram = _gram(distinct, centre, factors, size)
    composed = np.linalg.multi_dot([*reversed(factors)]) if len(factors) > 1 else factors[0]
    # gram is the identity but for directions that do not vary, where it is zero.
    values, vectors = np.linalg.eigh(gram)
    root = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T
    _, lengths, right = np.linalg.svd(root @ composed)
    kept = min(most, int((lengths > LEAST_SHARE * lengths[0]).sum()))
    return Whitening(centre, right[:kept].T, lengths[:kept] ** 2 / n, trace)


def whitened(vectors: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n (fit list), deviation, whitened, explained and identity_error of each vector."""
    rows = steps(vectors, column)
    distinct, size = fit_list(rows)
    model = fit(distinct, size, most)
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], kind)
    n = model.centre.n
    error = np.abs(_gram(distinct, model.centre, [], len(model.variances), model.projection) / n - np.eye(len(model.variances))).max()
    shared = vectors.sparkSession.sparkContext.broadcast((vars(model.centre), model.projection, model.variances / model.trace, float(error)))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, onto, explained, identity_error = shared.value
        own = Centre.__new__(Centre)
        vars(own).update(values)
        kept = len(explained)
        for batch in batches:
            for at, x in zip(range(0, batch.num_rows, ROWS), _matrices([batch]), strict=True):
                many = len(x)
                columns = [
                    batch.column("vec_id").slice(at, ROWS).take(pa.array(np.repeat(np.arange(many), kept))),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * kept, own.n)),
                    pa.array(own.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(many), kept))),
                    pa.array((own.rows(x) @ onto).reshape(-1)),
                    pa.array(np.tile(explained, many)),
                    pa.array(np.full(many * kept, identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in kind.split(", ")])

    return rows.filter(F.col("size") == size).select("vec_id", "x").mapInArrow(projected, kind)
