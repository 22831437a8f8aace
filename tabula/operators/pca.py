"""Principal components by a randomised range finder (D20, G4), for widths whose
width^2 covariance doesn't fit a driver.

A seeded Gaussian sketch of ``k + OVERSAMPLE`` columns is multiplied by the
covariance ``1 + POWER_ROUNDS`` times (Halko, Martinsson, Tropp, 2011). One
product is one pass: each task multiplies its centred rows by the sketch and
back and gives one row per feature, which are summed by feature in a shuffle.
The driver holds width x (k + OVERSAMPLE) numbers, orthogonalises them, and
solves a small eigenproblem at the end. Where k + OVERSAMPLE reaches the width
the result is exact.

Cases: null vectors and such of another width, or with a null or non-finite
number, are left out of the fit (their projection is null); fewer than two rows
have no variance and are an error; a component's largest loading is positive,
so signs don't depend on the sketch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.session import ship_package

OVERSAMPLE = 10
POWER_ROUNDS = 2
#: Most numbers of a sketch: what the driver and every task hold.
MAX_NUMBERS = 1 << 27


@dataclass
class Components:
    """``vectors`` (width x k), the mean, each component's variance and the total."""

    vectors: np.ndarray
    mean: np.ndarray
    variance: np.ndarray
    total_variance: float
    n: int

    @property
    def ratio(self) -> np.ndarray:
        return self.variance / self.total_variance if self.total_variance else np.zeros_like(self.variance)


def _whole(batch, width: int):
    """The usable rows of an Arrow list column as a matrix, and which they are."""
    import numpy as np

    column = batch.column("v")
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    usable = np.flatnonzero(sizes == width)
    rows = np.asarray(column.take(usable).flatten().cast("double").fill_null(np.nan)).reshape(-1, width)
    fine = np.isfinite(rows).all(1)
    return rows[fine], usable[fine]


def _moments(width: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        from tabula.operators.pca import _whole

        n, total, shift = 0, np.zeros(width), None
        for batch in batches:
            x, _ = _whole(batch, width)
            if len(x):
                shift = x[0] if shift is None else shift  # so that a large mean costs no digits
                n, total = n + len(x), total + (x - shift).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width)), pa.array(np.full(width, n)), pa.array(shift + total / n)], ["at", "n", "mean"])

    return run


def _product(mean, sketch):
    """Rows (feature, covariance sums times the sketch) of one task."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        from tabula.operators.pca import _whole

        out, seen = np.zeros(sketch.shape), False
        for batch in batches:
            x, _ = _whole(batch, len(mean))
            if len(x):
                x, seen = x - mean, True
                out += x.T @ (x @ sketch)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), pa.array(list(out), pa.list_(pa.float64()))], ["at", "row"])

    return run


def _times_covariance(vectors: DataFrame, mean, sketch):
    rows = vectors.mapInArrow(_product(mean, sketch), "at long, row array<double>")
    cells = rows.select("at", F.posexplode("row").alias("col", "x")).groupBy("at", "col").agg(F.sum("x").alias("x"))
    out = np.zeros(sketch.shape)
    for r in cells.collect():  # as many numbers as the sketch has
        out[r["at"], r["col"]] = r["x"]
    return out


def fit(df: DataFrame, vector_col: str, k: int, seed: int = 42, power_rounds: int = POWER_ROUNDS) -> Components:
    """The first ``k`` principal components of an array column."""
    ship_package(df.sparkSession)
    vectors = df.select(F.col(vector_col).cast("array<double>").alias("v")).filter("v is not null")
    width = vectors.agg(F.max(F.size("v"))).first()[0]
    if not width or not 1 <= k <= width:
        raise ValueError(f"k must be between 1 and the width ({width})")
    columns = min(width, k + OVERSAMPLE)
    if width * columns > MAX_NUMBERS:
        raise ValueError(f"width x (k + {OVERSAMPLE}): at most {MAX_NUMBERS}")
    parts = vectors.mapInArrow(_moments(width), "at long, n long, mean double")
    mean = F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    found = parts.groupBy("at").agg(F.sum("n").alias("n"), mean.alias("mean")).orderBy("at").collect()  # a row a feature
    if not found or found[0]["n"] < 2:
        raise ValueError("principal components need two rows or more")
    rows, centre = found[0]["n"], np.array([r["mean"] for r in found])
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((width, columns)))[0]
    for _ in range(1 + (power_rounds if columns < width else 0)):
        q = np.linalg.qr(_times_covariance(vectors, centre, q))[0]
    small = q.T @ _times_covariance(vectors, centre, q)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(values)[::-1][:k]
    loadings = q @ turn[:, best]
    loadings *= np.where(loadings[np.abs(loadings).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    total = vectors.mapInArrow(_spread(centre), "s double").agg(F.sum("s")).first()[0]
    return Components(loadings, centre, np.maximum(values[best], 0) / (rows - 1), total / (rows - 1), rows)


def _spread(mean):
    def run(batches):
        import pyarrow as pa

        from tabula.operators.pca import _whole

        for batch in batches:
            x, _ = _whole(batch, len(mean))
            yield pa.RecordBatch.from_arrays([pa.array([float(((x - mean) ** 2).sum())])], ["s"])

    return run


def project(df: DataFrame, vector_col: str, components: Components, out: str = "projected", centre: bool = True) -> DataFrame:
    """``df`` with the components' coordinates of a vector column and the squared
    distance to what they give back (``<out>_error``); null where a vector can't be used."""
    ship_package(df.sparkSession)
    schema = df.withColumn(out, F.lit(None).cast("array<double>")).withColumn(f"{out}_error", F.lit(None).cast("double")).schema
    mean = components.mean if centre else np.zeros_like(components.mean)
    return df.mapInArrow(_projector(vector_col, mean, components.vectors, schema.names), schema)


def _projector(vector_col: str, mean, vectors, names):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        from tabula.operators.pca import _whole

        for batch in batches:
            x, at = _whole(pa.RecordBatch.from_arrays([batch.column(vector_col)], ["v"]), len(mean))
            y = (x - mean) @ vectors
            error = ((x - mean - y @ vectors.T) ** 2).sum(1)
            coordinates, errors = [None] * batch.num_rows, [None] * batch.num_rows
            for i, row, e in zip(at.tolist(), y, error.tolist()):
                coordinates[i], errors[i] = row, e
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(coordinates, pa.list_(pa.float64())), pa.array(errors, pa.float64())], names)

    return run
