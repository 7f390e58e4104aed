"""Vector code compression: product quantization whose nearest-entry search is pruned by LAESA pivots.

Vectors become integers, are cut into equal consecutive parts, and each part position gets a codebook, refined by
rounds of assignment and integer means. The search of each round is exact: every part keeps its Euclidean distances
to a few fixed pivots (computed once and stored with the parts); per round only the small pivot-to-entry table is new.
By the triangle inequality ``|d(x, p) - d(p, e)|`` is a lower bound of ``d(x, e)``; entries are tried in order of that
bound, and once the bound of the next entry is above the best exact distance the part is done.

The work per round is one scan of the stored parts in Arrow batches; each batch sends partial sums per (part, entry)
and Spark adds them up, so what reaches the driver is one codebook, ``parts x entries`` rows, whatever the number of
vectors. A hot vector or label only adds to the same counters.

Nulls and odd rows, as defined results:

* a row whose vector is null, or holds a null, NaN or infinite component, is dropped;
* all vectors have the length of the first kept row (by id, nulls last, then by its integers); rows of another
  length are dropped, and a length that is not a positive multiple of ``parts`` leaves no rows;
* components must lie within +-4096 so that squared distances and their sums fit in 64-bit integers; rows beyond
  are dropped;
* input columns named ``__ints``, ``__pivot``, ``__code`` or ``__error`` are replaced;
* repeated rows and ids are separate vectors; the initial entries are the first ``entries`` rows ordered by id (nulls
  last) and then by their integers, so repeated ids are ordered by content;
* with fewer than ``entries`` kept rows the codebooks have as many entries as rows; an empty table gives no rows;
* null labels form one group of their own in ``label_error``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .common import stored

LIMIT = 4096.0


def _kept(rows: DataFrame, vector: str, scale: int) -> DataFrame:
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= LIMIT))
    return rows.where(v.isNotNull() & finite).withColumn(
        "__ints", F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _pivots(book: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first choice among the initial entries of one part position: fixed for all rounds."""
    chosen = [0]
    gap = ((book - book[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(book)):
        nxt = int(np.argmax(gap))
        chosen.append(nxt)
        gap = np.minimum(gap, ((book - book[nxt]) ** 2).sum(axis=1))
    return book[chosen]


def _nearest(x: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray):
    """Exact nearest entry (ties to the lower index) of every row of ``x``, pruned by pivot bounds."""
    n = len(x)
    pivot_entry = np.sqrt(((pivots[:, None, :] - book[None, :, :]) ** 2).sum(axis=2).astype(np.float64))
    bound = np.abs(to_pivots[:, :, None] - pivot_entry[None, :, :]).max(axis=1)
    bound = np.maximum(bound - 1e-7 * (1.0 + bound), 0.0) ** 2
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
    which = np.zeros(n, dtype=np.int64)
    rows = np.arange(n)
    exact = 0
    for rank in range(book.shape[0]):
        entry = order[:, rank]
        live = bound[rows, entry] <= best
        if not live.any():
            break
        idx = rows[live]
        e = entry[live]
        d = ((x[idx] - book[e]) ** 2).sum(axis=1)
        exact += len(idx)
        better = (d < best[idx]) | ((d == best[idx]) & (e < which[idx]))
        best[idx[better]] = d[better]
        which[idx[better]] = e[better]
    return which, best, exact


def _stack(series: pd.Series, width: int, dtype) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, width), dtype=dtype)
    return np.stack(series.to_numpy()).astype(dtype)


def quantize(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", parts: int = 8,
             entries: int = 16, rounds: int = 6, scale: int = 4096, pivots: int = 3) -> tuple[DataFrame, list]:
    """Codes of every kept row and the final codebooks.

    Returns the rows (all input columns but the vector, plus ``__code`` array<int> of entry indexes in part order and
    ``__error`` long, the summed squared distances) and the codebooks as nested lists
    ``[part][entry][position]`` of integers.
    """
    kept = _kept(rows.drop("__ints", "__pivot", "__code", "__error"), vector, scale)
    base = kept.drop(vector)
    order = [F.col(f"`{key}`").asc_nulls_last(), F.col("__ints")]
    head = kept.orderBy(*order).select(F.size("__ints")).limit(1).collect()
    dim = head[0][0] if head else 0
    if dim == 0 or dim % parts:
        nothing = base.drop("__ints").withColumns(
            {"__code": F.array().cast("array<int>"), "__error": F.lit(0).cast("long")})
        return nothing.limit(0), []
    body = base.where(F.size("__ints") == dim)
    first = body.orderBy(*order).select("__ints").limit(entries).collect()
    width = dim // parts
    start = np.array([r[0] for r in first], dtype=np.int64)
    books = [start[:, p * width:(p + 1) * width].copy() for p in range(parts)]
    fixed = [_pivots(b, pivots) for b in books]
    n_piv = [len(f) for f in fixed]

    def to_pivots(batches):
        piv = [f for f in fixed]
        for batch in batches:
            x = _stack(batch["__ints"], dim, np.int64)
            dist = np.concatenate([
                np.sqrt(((x[:, None, p * width:(p + 1) * width] - piv[p][None]) ** 2).sum(axis=2)
                        .astype(np.float64)) for p in range(parts)], axis=1) if len(x) else \
                np.zeros((0, sum(n_piv)))
            yield batch.assign(__pivot=list(dist))

    schema = T.StructType([*body.schema.fields, T.StructField("__pivot", T.ArrayType(T.DoubleType()))])
    parted = stored(body.mapInPandas(to_pivots, schema), "codebook-parts")

    def assign_all(batch_books: list[np.ndarray], batch: pd.DataFrame):
        x = _stack(batch["__ints"], dim, np.int64)
        dist = _stack(batch["__pivot"], sum(n_piv), np.float64)
        codes, errors, off = [], np.zeros(len(x), dtype=np.int64), 0
        for p in range(parts):
            which, best, _ = _nearest(x[:, p * width:(p + 1) * width], dist[:, off:off + n_piv[p]],
                                      batch_books[p], fixed[p])
            off += n_piv[p]
            codes.append(which)
            errors += best
        return x, np.stack(codes, axis=1) if codes else np.zeros((len(x), 0), np.int64), errors

    sums_schema = "part int, entry int, n long, total array<long>"
    for _ in range(rounds):
        now = [b.copy() for b in books]

        def partial_sums(batches, now=now):
            k = now[0].shape[0]
            acc = np.zeros((parts, k, width), dtype=np.int64)
            cnt = np.zeros((parts, k), dtype=np.int64)
            for batch in batches:
                x, code, _ = assign_all(now, batch)
                for p in range(parts):
                    np.add.at(acc[p], code[:, p], x[:, p * width:(p + 1) * width])
                    np.add.at(cnt[p], code[:, p], 1)
            p_idx, e_idx = np.nonzero(cnt)
            if len(p_idx):
                yield pd.DataFrame({"part": p_idx.astype(np.int32), "entry": e_idx.astype(np.int32),
                                    "n": cnt[p_idx, e_idx], "total": list(acc[p_idx, e_idx])})

        part_sums = parted.mapInPandas(partial_sums, sums_schema)
        summed = part_sums.select("part", "entry", "n", F.posexplode("total").alias("pos", "v")) \
            .groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
        for r in summed:
            books[r["part"]][r["entry"], r["pos"]] = r["v"] // r["n"]

    final = [b.copy() for b in books]

    def coded(batches):
        for batch in batches:
            _, code, errors = assign_all(final, batch)
            yield batch.drop(columns=["__ints", "__pivot"]).assign(
                __code=list(code.astype(np.int32)), __error=errors)

    out_schema = T.StructType([*parted.drop("__ints", "__pivot").schema.fields,
                               T.StructField("__code", T.ArrayType(T.IntegerType())),
                               T.StructField("__error", T.LongType())])
    return parted.mapInPandas(coded, out_schema), [b.tolist() for b in books]


def codebook_digest(books: list) -> str:
    """SHA-256 of all entries' integers by part, entry and position, comma-joined."""
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def digest(rows: DataFrame, books: list, key: str = "vec_id", label: str = "label") -> DataFrame:
    """The query's columns: code as hex, error, error per label (nulls together), codebook digest."""
    coded = rows.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{label}`").alias("__label"),
                        F.concat_ws("", F.transform("__code", lambda i: F.lpad(F.lower(F.hex(i)), 2, "0")))
                        .alias("code"), F.col("__error").alias("error"))
    per_label = coded.groupBy("__label").agg(F.sum("error").cast("long").alias("label_error"))
    joined = coded.join(per_label, coded["__label"].eqNullSafe(per_label["__label"]), "left")
    return joined.select("vec_id", "code", "error", "label_error",
                         F.lit(codebook_digest(books)).alias("codebooks_sha256"))
