"""PCA whitening of embeddings by a block Jacobi-Davidson method whose products run over the rows on Spark.

The covariance V is never formed. A product V u is a pass over the vectors, which are centred before they are multiplied; one pass
serves a block of directions, and what comes back to the driver has one row for each dimension. Outside, Rayleigh-Ritz on a growing
basis gives the leading pairs. Pairs whose residual is down to double precision are locked; for the others the correction equation,
projected away from locked and current vectors, is solved by a few steps of MINRES, all pairs side by side, so that each step is one
pass. The basis restarts from its best vectors when it is full.

Defined results: rows whose vector is null, empty or holds a null or non-finite entry go, and so do vectors of another length than
most (of lengths that are as frequent, the longest stays); repeated rows stay and count; null ids stay; directions without variance
(less than 1e-12 of the largest) have no component; fewer dimensions give fewer components; a table without variance or without rows
gives no rows; other columns are not returned. Entries of 2^34 and more, and deviations beyond 64 bits, raise an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.llm.common import stage

#: How vectors become whole numbers.
SCALE, OFFSET = 64, 1_000_000
#: Vectors in a stored block.
ROWS = 4096
#: Residuals count as nothing below so many units of the last place of the largest eigenvalue, times the root of the dimensions.
ULPS = 16
EPS = np.finfo(float).eps


def whole_vectors(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """Blocks of vectors, stored: ids, xs (64-bit integers, floor(64 c), as bytes); and their number of dimensions."""
    c = F.col(column)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    kept = embeddings.where(c.isNotNull() & (F.size(c) > 0) & ~bad).select(F.col(key).alias("id"), c.alias("v"))
    sizes = kept.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                xs = np.floor(SCALE * part["v"].flatten().to_numpy().astype(np.float64))
                if np.abs(xs).max() >= 2.0**40:
                    raise ValueError("an embedding has an entry of 2^34 or more")
                yield pa.RecordBatch.from_arrays([pa.array([part["id"].to_pylist()], pa.list_(part["id"].type)), pa.array([xs.astype(np.int64).tobytes()], pa.binary())], ["ids", "xs"])

    kind = kept.schema["id"].dataType.simpleString()
    return stage(kept.where(F.size("v") == d).mapInArrow(pack, f"ids array<{kind}>, xs binary"), "whitening-vectors")[0], d


def _summed(blocks: DataFrame, d: int, width: int, kind: str, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of make(vectors), a matrix of `width` columns, added up in the tasks and then on Spark."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for xs in batch["xs"]:
                total = total + make(np.frombuffer(xs.as_buffer(), np.int64).reshape(-1, d))
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), *(pa.array(np.ascontiguousarray(c)) for c in total.T)], ["at", *(f"c{i}" for i in range(width))])

    schema = ", ".join(["at long", *(f"c{i} {kind}" for i in range(width))])
    done = blocks.select("xs").mapInArrow(part, schema).groupBy("at").agg(*(F.sum(f"c{i}").alias(f"c{i}") for i in range(width))).orderBy("at").collect()
    return np.array([r[1:] for r in done])


def minres(product: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of product(x) = b for each column by itself; all columns step together, those done stand still."""
    beta = np.linalg.norm(b, axis=0)
    x, live = np.zeros_like(b), beta > 0
    safe = lambda v: np.where(v == 0, 1.0, v)
    old, v = np.zeros_like(b), b / safe(beta)
    w, w_old = np.zeros_like(b), np.zeros_like(b)
    eta, first = beta.copy(), beta.copy()
    c, c_old, s, s_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        if not live.any():
            break
        q = product(v) - beta * old
        alpha = (v * q).sum(axis=0)
        q -= alpha * v
        after = np.linalg.norm(q, axis=0)
        delta, near, far = c * alpha - c_old * s * beta, s * alpha + c_old * c * beta, s_old * beta
        length = np.hypot(delta, after)
        ok = live & (length > 0)
        c_old, s_old, c, s = c, s, np.where(ok, delta / safe(length), 1.0), np.where(ok, after / safe(length), 0.0)
        w_old, w = w, (v - far * w_old - near * w) / safe(length)
        x = x + np.where(ok, c * eta, 0.0) * w
        eta = np.where(ok, -s * eta, eta)
        old, v, beta = v, q / safe(after), after
        live = ok & (after > 0) & (np.abs(eta) > tolerance * first)
    return x


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of new add to the given bases."""
    kept = np.zeros((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):
            for base in (*against, kept):
                column = column - base @ (base.T @ column)
        size = np.linalg.norm(column)
        if size > 1e-10:
            kept = np.column_stack([kept, column / size])
            again = kept[:, -1]
            for base in (*against, kept[:, :-1]):
                again = again - base @ (base.T @ again)
            kept[:, -1] = again / np.linalg.norm(again)
    return kept


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, inner: int = 6, rounds: int = 300, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric operator, falling, and their unit vectors as columns.

    product(block) applies the operator to d x k columns. Returns when all wanted residuals are at double precision.
    """
    wanted = min(wanted, d)
    most = min(d, max(3 * wanted, wanted + 20))
    locked, values = np.zeros((d, 0)), np.zeros(0)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, wanted + 4))))
    image = product(basis)
    largest = 0.0
    for turn in range(rounds):
        # basis holds the locked vectors no longer; pairs are taken from the largest down
        theta, y = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        need = wanted - len(values)
        u, au = basis @ y, image @ y
        largest = max(largest, theta[0])
        residual = au[:, :need] - theta[:need] * u[:, :need]
        residual = residual - locked @ (locked.T @ residual)
        small = np.linalg.norm(residual, axis=0) <= ULPS * EPS * np.sqrt(d) * max(largest, np.finfo(float).tiny)
        full = basis.shape[1] + locked.shape[1] >= d  # nothing is left outside: what the basis says is exact
        done = need if full else int(np.argmin(np.append(small, False)))
        if done:
            locked, values = np.column_stack([locked, u[:, :done]]), np.concatenate([values, theta[:done]])
            if len(values) >= wanted:
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order]
            u, au, theta, residual = u[:, done:], au[:, done:], theta[done:], residual[:, done:]
            need -= done
        basis, image = u, au
        if basis.shape[1] + need > most:
            keep = max(need + 4, most - need - len(values)) if most > 2 * need else need + 4
            basis, image = basis[:, :keep], image[:, :keep]
        now, shift = u[:, :need], theta[:need]
        out = lambda t: t - locked @ (locked.T @ t) - now @ (now.T @ t)  # noqa: E731, B023
        new = minres(lambda t: out(product(t) - shift * t), -out(residual[:, :need]), inner, 0.5 ** (turn + 1))  # noqa: B023
        new = _orthonormal(np.where(np.isfinite(new), new, 0.0), locked, basis)
        if not new.shape[1]:  # residuals too small to point anywhere
            new = _orthonormal(np.random.default_rng(turn + 1).standard_normal((d, 1)), locked, basis)
        if new.shape[1]:
            basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
    raise RuntimeError("the eigenvectors did not converge")


def whiten(embeddings: DataFrame, components: int = 32, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    blocks, d = whole_vectors(embeddings, column, key)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not d:
        return blocks.sparkSession.createDataFrame([], schema)
    counted = _summed(blocks, d, 2, "long", lambda xs: np.column_stack([np.full(d, len(xs)), xs.sum(axis=0)]))
    n, sums = int(counted[0, 0]), [int(s) for s in counted[:, 1]]
    mean = np.array([s / n for s in sums])  # a division of whole numbers, rounded once
    trace = float(_summed(blocks, d, 1, "double", lambda xs: ((xs - mean) ** 2).sum(axis=0)[:, None]).sum()) / n

    def product(u: np.ndarray) -> np.ndarray:
        def make(xs: np.ndarray) -> np.ndarray:
            centred = xs - mean
            return centred.T @ (centred @ u)

        return _summed(blocks, d, u.shape[1], "double", make) / n

    if trace == 0:
        return blocks.sparkSession.createDataFrame([], schema)
    values, vectors = jacobi_davidson(product, d, components)
    real = values > 1e-12 * values[0]
    values, vectors = values[real], vectors[:, real]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    onto = vectors / np.sqrt(values)
    k = len(values)

    def moments(xs: np.ndarray) -> np.ndarray:
        w = (xs - mean) @ onto
        return np.vstack([w.T @ w, w.sum(axis=0)])

    found = _summed(blocks, d, k, "double", moments) / n
    error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
    share = values / trace
    total = np.array(sums, dtype=object)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, xs in zip(batch["ids"], batch["xs"]):
                x = np.frombuffer(xs.as_buffer(), np.int64).reshape(-1, d)
                whitened = (x - mean) @ onto
                rough = ((x - mean) ** 2).sum(axis=1) * float(n) ** 2
                if rough.max() < 2.0**62:
                    off = n * x - np.array(sums, np.int64)
                    deviation = (off * off).sum(axis=1)
                else:
                    deviation = [int(v) for v in ((n * x.astype(object) - total) ** 2).sum(axis=1)]
                    if max(deviation) >= 2**63:
                        raise OverflowError("a deviation does not fit into 64 bits")
                    deviation = np.array(deviation, np.int64)
                m = len(x)
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(np.repeat(deviation, k)),
                    pa.array(whitened.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))], [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(rows, schema)
