"""Truncated SVD of a sparse matrix that no single machine has to hold.

The matrix is a table of cells (id, idx, value), or of rows of them (id, array of idx, array of
value); its right singular vectors are a table (idx, p0, p1, ...) with one array
column for each panel of components. A random sign matrix, made from hashes of the
column index, is multiplied by the matrix and its transpose a few times (Halko,
Martinsson and Tropp, 2011). A panel goes to every task, which makes both
products of its rows and adds up the second; only these sums are shuffled, so that the cells, written once
and compressed, stay where they are. A panel has as many columns as fit BROADCAST_BYTES, at
most PANEL; where not even two do, products are joins and sums of single cells. Between
the products the columns are made orthonormal by a QR of tall blocks: every task
reduces its rows to one triangular factor, factors are stacked and reduced again in
a tree, and only the last, components x components, reaches the driver.

Defined results: a row without cells projects to zeros; features that were not in
the fitted cells are dropped; there are never more components than the matrix has
rank. Singular vectors have no sign of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.session import checkpointed, removed, scratch_path, stored

PANEL = 32
#: Components at most: the driver holds a few matrices of this size squared.
MAX_COMPONENTS = 4000
BROADCAST_BYTES = 64 << 20
#: Cells that a task multiplies at once, and features of a row of the sums it shuffles.
SLICE_CELLS, BLOCK = 1 << 20, 1 << 12
FAN_IN = 8
#: Singular values below this share of the largest count as zero.
ZERO = 1e-10


def _unpacked(panel: str, width: int, prefix: str) -> list[Column]:
    return [F.col(panel)[j].alias(f"{prefix}{j}") for j in range(width)]


def _widths(total: int, panel: int) -> list[int]:
    return [min(panel, total - at) for at in range(0, total, panel)]


def _sums(width: int, prefix: str, made: str) -> list[Column]:
    return [F.sum(F.col("value") * F.col(f"{prefix}{j}")).alias(f"{made}{j}") for j in range(width)]


def _times(cells: DataFrame, right: DataFrame, n_features: int, width: int) -> DataFrame:
    """(id, y0, ...): the matrix times one panel (idx, z0, ...)."""
    small = n_features * (width + 1) * 8 <= BROADCAST_BYTES
    joined = cells.join(F.broadcast(right) if small else right, "idx")
    return joined.groupBy("id").agg(*_sums(width, "z", "y"))


def _transposed_times(cells: DataFrame, left: DataFrame, width: int) -> DataFrame:
    """(idx, z0, ...): the transposed matrix times one panel (id, y0, ...)."""
    return cells.join(left, "id").groupBy("idx").agg(*_sums(width, "y", "z"))


def _random_signs(features: DataFrame, seed: int, start: int, width: int, panel: int) -> DataFrame:
    """(idx, z): the columns from ``start`` on of a matrix whose signs are the bits of hashes, one for each ``panel`` columns."""
    hashes = {j // panel for j in range(start, start + width)}
    bits = [F.xxhash64(F.lit(seed), F.lit(j), "idx").alias(f"_bits{j}") for j in sorted(hashes)]
    signs = [F.lit(1.0) - 2 * F.shiftrightunsigned(f"_bits{j // panel}", j % panel).bitwiseAND(F.lit(1)) for j in range(start, start + width)]
    return features.select("idx", *bits).select("idx", F.array(*signs).alias("z"))


# --- products over rows of cells --------------------------------------------------------


def _is_packed(cells: DataFrame) -> bool:
    return dict(cells.dtypes)["idx"].startswith("array")


def packed(cells: DataFrame) -> DataFrame:
    """(id, idx, value) with the cells of an id in one row of two arrays."""
    known = cells.where(F.col("idx").isNotNull() & F.col("value").isNotNull())
    cell = F.struct(F.col("idx").cast("long").alias("i"), F.col("value").cast("double").alias("v"))
    rows = known.groupBy("id").agg(F.collect_list(cell).alias("_cells"))
    return rows.select("id", F.col("_cells.i").alias("idx"), F.col("_cells.v").alias("value"))


def _unpacked_cells(rows: DataFrame) -> DataFrame:
    return rows.select("id", F.inline(F.arrays_zip("idx", "value")))


def _fits(n_features: int) -> bool:
    return 2 * 8 * n_features <= BROADCAST_BYTES


def _panel(panel: int, n_features: int) -> int:
    return min(panel, BROADCAST_BYTES // (8 * max(n_features, 1))) if _fits(n_features) else panel


class _Factor:
    """A panel (idx, z) by column on every executor, and products of rows (id, idx, value) with it."""

    def __init__(self, right: DataFrame):
        table = right.toArrow()
        known = table.column("idx").to_numpy()
        order = np.argsort(known)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        # One copy besides the table: a panel may have BROADCAST_BYTES.
        columns, at = np.empty((len(table.column("z")[0]) if len(known) else 0, len(known))), 0
        for batch in table.to_batches():
            if batch.num_rows:
                columns[:, place[at : at + batch.num_rows]] = _rows(batch, "z").T
                at += batch.num_rows
        known = known[order]
        del table
        context = right.sparkSession.sparkContext
        self.tasks, self.shared = context.defaultParallelism, context.broadcast((known, columns))

    def _left(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Slices of rows with their numbers of known cells, the positions and values of these, and the first product by column."""
        known, right = self.shared.value
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column("idx")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = (np.cumsum(sizes) - sizes) // SLICE_CELLS
            bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
            for start, end in zip(bounds[:-1], bounds[1:]):
                if start == end or not len(known):
                    continue
                some, size = batch.slice(start, end - start), sizes[start:end]
                idx, value = (some.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("idx", "value"))
                row = np.repeat(np.arange(len(size)), size)
                at = np.minimum(np.searchsorted(known, idx), len(known) - 1)
                found = known[at] == idx
                if not found.all():
                    row, at, value = row[found], at[found], value[found]
                    size = np.bincount(row, minlength=len(size))
                left = np.empty((len(right), len(size)))
                for j, column in enumerate(right):
                    left[j] = np.bincount(row, column[at] * value, len(size))
                yield some, size, at, value, left

    def times(self, rows: DataFrame) -> DataFrame:
        """(id, z): the rows times the panel, without rows that share no feature with it."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for some, size, _, _, left in self._left(batches):
                kept = size > 0
                yield pa.RecordBatch.from_arrays([some.column("id").filter(pa.array(kept)), _as_lists(left.T[kept])], names=["id", "z"])

        return rows.select("id", "idx", "value").mapInArrow(run, f"id {dict(rows.dtypes)['id']}, z array<double>")

    def squared(self, rows: DataFrame) -> DataFrame:
        """(idx, z): the transposed matrix times the matrix times the panel; rows without id are left out.

        A task shuffles its sums for the features it met, as one row for each BLOCK of features.
        """
        few = rows.where(F.col("id").isNotNull()).select("id", "idx", "value").coalesce(self.tasks)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, right = self.shared.value
            sums, met = np.zeros_like(right), np.zeros(len(known), bool)
            for _, size, at, value, left in self._left(batches):
                met[at] = True
                for j in range(len(right)):
                    sums[j] += np.bincount(at, np.repeat(left[j], size) * value, len(known))
            for start in range(0, len(known), BLOCK):
                at = np.flatnonzero(met[start : start + BLOCK])
                if len(at):
                    z = _as_lists(sums[:, start + at].T.reshape(1, -1))
                    place = pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pa.array(at.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([pa.array([start // BLOCK], pa.int32()), place, z], names=["block", "at", "z"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, right = self.shared.value
            blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for i, block in enumerate(batch.column("block").to_pylist()):
                    sums, met = blocks.setdefault(block, (np.zeros((BLOCK, len(right))), np.zeros(BLOCK, bool)))
                    at, z = (batch.column(c).slice(i, 1).flatten().to_numpy(zero_copy_only=False) for c in ("at", "z"))
                    sums[at] += z.reshape(len(at), -1)
                    met[at] = True
            for block, (sums, met) in blocks.items():
                at = np.flatnonzero(met)
                yield pa.RecordBatch.from_arrays([pa.array(known[block * BLOCK + at]), _as_lists(sums[at])], names=["idx", "z"])

        made = few.mapInArrow(run, "block int, at array<int>, z array<double>")
        return made.repartition(self.tasks, "block").mapInArrow(add, "idx long, z array<double>")

    def gone(self) -> None:
        self.shared.destroy()


# --- tables whose rows are whole arrays -------------------------------------------------


def _rows(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _as_lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    offsets = np.arange(0, n * width + 1, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def triangular_factor(table: DataFrame, column: str, width: int) -> np.ndarray:
    """R of the QR of all rows of an array column, reduced in a tree of tasks."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.zeros((0, width))
        for batch in batches:
            rows = _rows(batch, column)
            # Tall enough slices, so that a factor is not remade for a few rows.
            for at in range(0, len(rows), 4 * width):
                factor = np.linalg.qr(np.vstack([factor, rows[at : at + 4 * width]]), mode="r")
        if len(factor):
            yield pa.RecordBatch.from_arrays([_as_lists(factor)], names=[column])

    factors = checkpointed(table.select(column).mapInArrow(reduce, f"{column} array<double>"))
    parts = factors.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // FAN_IN)
        factors = checkpointed(factors.coalesce(parts).mapInArrow(reduce, f"{column} array<double>"))
    last = np.array([r[0] for r in factors.collect()]).reshape(-1, width)
    return np.vstack([last, np.zeros((max(0, width - len(last)), width))])


def multiplied(table: DataFrame, key: str, column: str, matrix: np.ndarray) -> DataFrame:
    """(key, column): every row of the array column times a small matrix."""
    shared = table.sparkSession.sparkContext.broadcast(matrix)
    kind = dict(table.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _as_lists(_rows(batch, column) @ shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(key), made], names=[key, column])

    return table.select(key, column).mapInArrow(run, f"{key} {kind}, {column} array<double>")


class _Panels:
    """Panels (key, z) written one after the other, read as whole rows."""

    def __init__(self, like: DataFrame, key: str):
        self.spark, self.key, self.path = like.sparkSession, key, scratch_path(like.sparkSession, "panels")
        self.count = 0

    def add(self, number: int, panel: DataFrame) -> None:
        panel.select(self.key, "z").write.parquet(f"{self.path}/panel={number}")
        self.count += 1

    def whole(self) -> DataFrame:
        """(key, z): the panels of each row side by side; a row has one row in each panel."""
        written = self.spark.read.parquet(self.path)
        if self.count == 1:
            return written.select(self.key, "z")
        parts = F.array_sort(F.collect_list(F.struct("panel", "z")))
        joined = F.flatten(F.transform(parts, lambda part: part["z"]))
        return written.groupBy(self.key).agg(joined.alias("z"))

    def gone(self) -> None:
        removed(self.spark, self.path)


def _stored(table: DataFrame, key: str, widths: list[int]) -> tuple[DataFrame, str]:
    """(key, p0, p1, ...) written so that one panel is read alone, and the path."""
    path = scratch_path(table.sparkSession, "vectors")
    at = np.cumsum([0, *widths]).tolist()
    columns = [F.slice("z", at[j] + 1, width).alias(f"p{j}") for j, width in enumerate(widths)]
    table.select(key, *columns).write.parquet(path)
    return table.sparkSession.read.parquet(path), path


def _orthonormal(table: DataFrame, width: int) -> tuple[DataFrame, int]:
    """(idx, z) with orthonormal columns that span those of ``table``, and their number.

    Done twice: rounding of the first pass grows with the condition of the columns.
    """
    for _ in range(2):
        _, sizes, turned = np.linalg.svd(triangular_factor(table, "z", width))
        kept = int((sizes > ZERO * max(sizes[0], 1e-300)).sum())
        if kept == 0:
            return table, 0
        table = multiplied(table, "idx", "z", turned[:kept].T / sizes[:kept])
        width = kept
    return table, width


@dataclass
class TruncatedFactors:
    """Right singular vectors (idx, p0, p1, ...) and singular values of a matrix."""

    vectors: DataFrame
    singular: np.ndarray
    n_features: int
    panel: int

    @property
    def k(self) -> int:
        return len(self.singular)

    def project(self, cells: DataFrame) -> DataFrame:
        """(id, z): the rows of ``cells`` times the right singular vectors."""
        if not _is_packed(cells):
            return self._project(packed(cells) if _fits(self.n_features) else cells)
        made = self._project(cells if _fits(self.n_features) else _unpacked_cells(cells))
        if not _fits(self.n_features):
            return made
        # The rows of an id may be several.
        total = [F.sum(F.col("z")[j]).alias(f"z{j}") for j in range(self.k)]
        return made.groupBy("id").agg(*total).select("id", F.array(*[f"z{j}" for j in range(self.k)]).alias("z")) if self.k else made

    def _project(self, cells: DataFrame) -> DataFrame:
        widths = _widths(self.k, self.panel)
        if not widths:
            return cells.select("id", F.array().cast("array<double>").alias("z")).limit(0)
        if len(widths) == 1 and _is_packed(cells):
            return _Factor(self.vectors.select("idx", F.col("p0").alias("z"))).times(cells)
        made = _Panels(cells, "id")
        for j, width in enumerate(widths):
            if _is_packed(cells):
                factor = _Factor(self.vectors.select("idx", F.col(f"p{j}").alias("z")))
                made.add(j, factor.times(cells))
                factor.gone()
            else:
                right = self.vectors.select("idx", *_unpacked(f"p{j}", width, "z"))
                found = _times(cells, right, self.n_features, width)
                made.add(j, found.select("id", F.array(*[f"y{i}" for i in range(width)]).alias("z")))
        return made.whole()


def truncated_svd(
    cells: DataFrame, k: int, oversample: int = 10, passes: int = 5, seed: int = 659, panel: int = PANEL
) -> TruncatedFactors:
    """The ``k`` largest singular triplets of a sparse matrix of cells (id, idx, value).

    ``cells`` may also be rows (id, array of idx, array of value), one for each id, which must be written already.
    ``passes`` is how often the matrix and its transpose are applied before the
    last product. The error falls with each by the square of the ratio of the
    singular values left out to those kept.
    """
    rows, rows_path = (cells, None) if _is_packed(cells) else stored(packed(cells), "cells")
    spark = rows.sparkSession
    features, features_path = stored(rows.select(F.explode("idx").alias("idx")).distinct(), "features")
    n_features = features.count()
    if min(k, n_features) > MAX_COMPONENTS:
        raise ValueError(f"{k} components exceed {MAX_COMPONENTS}")
    together, kept_panel, panel = _fits(n_features), panel, _panel(panel, n_features)
    by_cell = None if together else _unpacked_cells(rows).repartition("id")
    width = min(k + oversample, n_features, rows.count())
    basis: DataFrame | None = None
    basis_path = None
    for step in range(passes):
        made, widths = _Panels(rows, "idx"), _widths(width, panel)
        for j, size in enumerate(widths):
            if basis is None:
                right = _random_signs(features, seed, j * panel, size, kept_panel)
            else:
                right = basis.select("idx", F.col(f"p{j}").alias("z"))
            if together:
                factor = _Factor(right)
                made.add(j, factor.squared(rows))
                factor.gone()
            else:
                product = _times(by_cell, right.select("idx", *_unpacked("z", size, "z")), n_features, size)
                product = _transposed_times(by_cell, product, size)
                made.add(j, product.select("idx", F.array(*[f"z{i}" for i in range(size)]).alias("z")))
        if not widths:
            break
        table, table_path = (made.whole(), None) if made.count == 1 else stored(made.whole(), "table")
        table, width = _orthonormal(table, width)
        before, (basis, basis_path) = basis_path, _stored(table, "idx", _widths(width, panel))
        made.gone()
        for path in filter(None, (before, table_path)):
            removed(spark, path)
    found = TruncatedFactors(features.select("idx"), np.zeros(0), n_features, panel)
    if basis is not None and width:
        # The matrix in the basis: its singular values and vectors are those of the triangular factor.
        found = TruncatedFactors(basis, np.ones(width), n_features, panel)
        _, singular, turned = np.linalg.svd(triangular_factor(found._project(rows if together else by_cell), "z", width))
        rank = min(k, int((singular > ZERO * singular[0]).sum()))
        whole = basis.select("idx", F.concat(*[c for c in basis.columns if c != "idx"]).alias("z"))
        vectors, _ = _stored(multiplied(whole, "idx", "z", turned[:rank].T), "idx", _widths(rank, panel))
        found = TruncatedFactors(vectors, singular[:rank], n_features, panel)
        for path in filter(None, (basis_path, features_path, rows_path)):
            removed(spark, path)
    return found
