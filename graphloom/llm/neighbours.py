"""The most similar vectors of every vector, by cosine.

Cells: spherical k-means on a bounded sample gives centroids, and every vector goes to its SPILL nearest cells, so that two
similar vectors share one almost always. In a cell, vectors are held as four-bit codes of an anisotropic product quantiser
(codebooks and codes weigh the residual's part along the vector ETA times as much as the rest, for that part is what changes
scores). Tables of sixteen products a subspace, in pairs as bytes, score every code; the best SHORTLIST are ranked again by
exact products. The lists of a vector's cells are merged to its k nearest.

Vectors travel as 16-bit integers with a scale (an error of some 1e-5 in a cosine). The cells of the whole table are bounded in
number, for the driver holds their centroids; a task whose cell has more than SPLIT_ROWS different vectors makes a second level of
cells of its own, with CELL_ROWS vectors each, so that the work grows with the rows and not with the square of a cell. A cell that
the sample shows to be beyond BLOCK_ROWS is also cut into blocks: its rows stand in one block and ask all of them, so that no task
takes an unbounded cell. Equal vectors of a block are scored once.

Cases: of several writes of an id the one with the greatest number counts (of equal numbers, the greatest code); vectors that
are null, of another length, not finite or all zero are compared with nothing; ties go to the smaller key; fewer than two
vectors, or an empty table, give no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIM = 64
#: Vectors in one cell, about, and the bounds of the number of cells.
CELL_ROWS, LEAST_CELLS, MOST_CELLS = 256, 1, 8192
#: The sample for the centroids holds so many vectors a cell (196,608 at most), for the codebooks CODE_SAMPLE of them.
SAMPLE_A_CELL, CODE_SAMPLE = 24, 8192
SPILL, SHORTLIST, ETA = 3, 32, 4.0
#: Different vectors of a cell from which a task makes a second level of cells, and the number of them that each query asks.
SPLIT_ROWS, INNER_SPILL = 4096, 6
#: Vectors that the centroids of the second level are made of, for each of these cells.
INNER_SAMPLE = 16
#: Rows of one block of a cell (150 bytes each as they travel, 256 unpacked).
BLOCK_ROWS = 200_000
SUBSPACES, CODES = 32, 16
QUERY_ROWS = 256


def key_of(ident: Column) -> Column:
    """A short binary key of an id, from which the id can be read again."""
    short = F.concat(F.encode(F.concat(F.lit("h"), F.substring(ident, 1, 4)), "UTF-8"), F.unhex(F.substring(ident, 5, 32)))
    return F.when(ident.rlike("^[a-z]{3}-[0-9a-f]{32}$"), short).otherwise(F.concat(F.encode(F.lit("s"), "UTF-8"), F.encode(ident, "UTF-8")))


def id_of(key: bytes) -> str:
    return key[1:5].decode() + key[5:].hex() if key[:1] == b"h" else key[1:].decode()


def pack(v: np.ndarray) -> list[bytes]:
    """Unit vectors as 16-bit integers, each with its scale."""
    scale = (np.abs(v).max(axis=1) / 32767).astype(np.float32)
    q = np.rint(v / scale[:, None]).astype(np.int16)
    raw = np.concatenate([q.view(np.uint8), scale[:, None].view(np.uint8)], axis=1)
    return [r.tobytes() for r in raw]


def unpack(codes: pa.Array) -> np.ndarray:
    """Unit vectors of packed ones."""
    raw = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.uint8).reshape(len(codes), 2 * DIM + 4)
    q = np.ascontiguousarray(raw[:, : 2 * DIM]).view(np.int16).astype(np.float32)
    v = q * np.ascontiguousarray(raw[:, 2 * DIM :]).view(np.float32)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = b.column(2)
        ok = np.asarray(v.is_valid())
        codes: list[bytes | None] = [None] * len(b)
        if ok.any():
            m = v.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, DIM)
            m /= np.abs(m).max(axis=1, keepdims=True)
            m /= np.linalg.norm(m, axis=1, keepdims=True)
            for i, c in zip(np.flatnonzero(ok), pack(m), strict=True):
                codes[i] = c
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes, pa.binary())], names=["key", "seq", "code"])


def valid(vector: Column) -> Column:
    """The vector where it can be compared, else null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when((F.size(vector) == DIM) & finite & F.exists(vector, lambda x: x != 0), vector)


def spherical_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit vectors; one that loses all its vectors stays where it was."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = np.concatenate([np.argmax(x[i : i + 2048] @ c.T, axis=1) for i in range(0, len(x), 2048)])
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
        sums = np.add.reduceat(x[order], first, axis=0)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        hit = at[order][first]
        c[hit] = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c[hit])
    return c


def encode(x: np.ndarray, books: np.ndarray, rounds: int = 1) -> np.ndarray:
    """Four-bit codes by coordinate descent on |r|^2 + (ETA - 1) (r.x)^2, r the residual; one byte a subspace."""
    n = len(x)
    parts = np.ascontiguousarray(x.reshape(n, SUBSPACES, -1).transpose(1, 0, 2))
    product = np.matmul(parts, books.transpose(0, 2, 1))  # subspace, vector, codeword
    own = (parts * parts).sum(2)[:, :, None]
    along = own - product  # the part of r.x that each codeword leaves
    square = along - product + (books * books).sum(2)[:, None, :]
    codes = square.argmin(axis=2)
    now = np.take_along_axis(along, codes[:, :, None], 2)[:, :, 0]
    total = now.sum(axis=0)
    for _ in range(rounds):
        for s in range(SUBSPACES):
            cost = along[s] + (total - now[s])[:, None]
            cost *= cost
            cost *= ETA - 1
            cost += square[s]
            new = cost.argmin(axis=1)
            fresh = along[s][np.arange(n), new]
            total += fresh - now[s]
            now[s], codes[s] = fresh, new
    return np.ascontiguousarray(codes.T.astype(np.uint8))


def codebooks(x: np.ndarray, rounds: int = 6, seed: int = 7) -> np.ndarray:
    """Codewords of each subspace that least cost the anisotropic loss: codes and codewords in turn. The best codewords, given
    codes, solve a small linear system each."""
    rng = np.random.default_rng(seed)
    width = x.shape[1] // SUBSPACES
    parts = x.reshape(len(x), SUBSPACES, width)
    pick = rng.choice(len(x), CODES, replace=len(x) < CODES)
    books = np.ascontiguousarray(parts[pick].transpose(1, 0, 2)).astype(np.float32)
    books += rng.normal(0, 1e-4, books.shape).astype(np.float32)
    for _ in range(rounds):
        codes = encode(x, books, 1)
        r = parts - books[np.arange(SUBSPACES)[None], codes]
        along = (r * parts).sum(2)
        total = along.sum(1)
        for s in range(SUBSPACES):
            p = parts[:, s]
            outer = np.eye(width)[None] + (ETA - 1) * p[:, :, None] * p[:, None, :]
            right = p + (ETA - 1) * ((total - along[:, s]) + (p * p).sum(1))[:, None] * p
            for c in range(CODES):
                mine = codes[:, s] == c
                if mine.any():
                    books[s, c] = np.linalg.solve(outer[mine].sum(0), right[mine].sum(0))
    return books


def scan(queries: np.ndarray, codes: np.ndarray, books: np.ndarray, n: int) -> np.ndarray:
    """Places of the n codes with the best table scores for each query. Tables are rounded to bytes, two subspaces each."""
    q = len(queries)
    tables = np.einsum("qsw,scw->qsc", queries.reshape(q, SUBSPACES, -1), books)
    pairs = (tables[:, 0::2, :, None] + tables[:, 1::2, None, :]).reshape(q, SUBSPACES // 2, CODES * CODES)
    least, most = tables.min(axis=2), tables.max(axis=2)
    low, high = least[:, 0::2] + least[:, 1::2], most[:, 0::2] + most[:, 1::2]
    step = np.maximum((high - low).max(axis=1) / 255, 1e-9)[:, None, None]
    pairs -= low[:, :, None]
    pairs /= step
    bytes_ = np.rint(pairs, out=pairs).astype(np.uint8)
    both = codes[:, 0::2].astype(np.intp) * CODES + codes[:, 1::2]
    score = np.zeros((q, len(codes)), dtype=np.uint16)
    for s in range(SUBSPACES // 2):
        score += np.take(bytes_[:, s], both[:, s], axis=1)
    return np.argpartition(score, len(codes) - n, axis=1)[:, len(codes) - n :]


def nearest(queries: np.ndarray, base: np.ndarray, books: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first query, places, cosines) of blocks of queries: the places in ``base`` of the k best of each, best first, by exact products
    of the shortlist that the table scan leaves."""
    codes = encode(base, books) if len(base) > SHORTLIST else None
    for at in range(0, len(queries), QUERY_ROWS):
        q = queries[at : at + QUERY_ROWS]
        if codes is None:
            short = np.broadcast_to(np.arange(len(base)), (len(q), len(base)))
        else:
            short = scan(q, codes, books, SHORTLIST)
        exact = np.matmul(base[short], q[:, :, None])[:, :, 0]
        if exact.shape[1] > k:
            best = np.argpartition(-exact, k - 1, axis=1)[:, :k]
            short, exact = np.take_along_axis(short, best, 1), np.take_along_axis(exact, best, 1)
        order = np.argsort(-exact, axis=1, kind="stable")
        yield at, np.take_along_axis(short, order, 1), np.take_along_axis(exact, order, 1)


def inner_cells(base: np.ndarray) -> np.ndarray:
    """Centroids of the second level."""
    k = max(2, len(base) // CELL_ROWS)
    pick = np.random.default_rng(7).permutation(len(base))[: INNER_SAMPLE * k]
    return spherical_means(base[pick], k, rounds=4)


def nearest_in_cells(queries: np.ndarray, base: np.ndarray, books: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(queries, places, cosines) like ``nearest``, with the numbers of the queries. Many base vectors lie in cells of the second level,
    each in one, and every query asks the nearest of them; its best are merged over these cells."""
    if len(base) <= SPLIT_ROWS:
        yield from ((np.arange(at, at + len(p)), p, c) for at, p, c in nearest(queries, base, books, k))
        return
    centroids = inner_cells(base)
    spill = min(INNER_SPILL, len(centroids))
    home = np.concatenate([np.argmax(base[i : i + 2048] @ centroids.T, axis=1) for i in range(0, len(base), 2048)])
    near = [np.argpartition(-(queries[i : i + 2048] @ centroids.T), spill - 1, axis=1)[:, :spill] for i in range(0, len(queries), 2048)]
    asked = np.concatenate(near) if near else np.zeros((0, spill), dtype=np.int64)
    place = np.full((len(queries), spill * k), -1, dtype=np.int64)
    score = np.full((len(queries), spill * k), -2.0, dtype=np.float32)
    by_home, by_asked = np.argsort(home, kind="stable"), np.argsort(asked.ravel(), kind="stable")
    edges = np.arange(len(centroids) + 1)
    home_at, asked_at = np.searchsorted(home[by_home], edges), np.searchsorted(asked.ravel()[by_asked], edges)
    for c in range(len(centroids)):
        held, flat = by_home[home_at[c] : home_at[c + 1]], by_asked[asked_at[c] : asked_at[c + 1]]
        if not len(held) or not len(flat):
            continue
        who, turn = flat // spill, flat % spill
        for at, p, cos in nearest(queries[who], base[held], books, k):
            rows, columns = who[at : at + len(p)], turn[at : at + len(p)][:, None] * k + np.arange(p.shape[1])
            place[rows[:, None], columns], score[rows[:, None], columns] = held[p], cos
    for at in range(0, len(queries), QUERY_ROWS):
        part = score[at : at + QUERY_ROWS]
        order = np.argsort(-part, axis=1, kind="stable")[:, :k]
        yield np.arange(at, at + len(part)), np.take_along_axis(place[at : at + QUERY_ROWS], order, 1), np.take_along_axis(part, order, 1)


def _framed(key: bytes) -> bytes:
    """A key with its length before it."""
    return bytes([len(key)]) + key if 0 < len(key) < 256 else b"\0" + struct.pack("<I", len(key)) + key


def _cell(books: np.ndarray, k: int, least: float):
    def work(t: pa.Table) -> pa.Table:
        keys, code = t.column("key").to_pylist(), t.column("code").combine_chunks()
        base_row, asks = np.asarray(t.column("base")), np.asarray(t.column("asks"))
        # equal vectors are scored once
        seen: dict[bytes, int] = {}
        group = np.array([seen.setdefault(c, len(seen)) for c in code.to_pylist()])
        first = np.full(len(seen), -1)
        first[group[::-1]] = np.arange(len(group))[::-1]
        v = unpack(code.take(pa.array(first)))
        held: list[list[bytes]] = [[] for _ in range(len(seen))]
        asking: list[list[bytes]] = [[] for _ in range(len(seen))]
        for i, g in enumerate(group.tolist()):
            if base_row[i]:
                held[g].append(keys[i])
            if asks[i]:
                asking[g].append(keys[i])
        for h in held:
            if len(h) > 1:
                h.sort()
                del h[k + 1 :]
        there, asked = np.flatnonzero([bool(h) for h in held]), np.flatnonzero([bool(x) for x in asking])
        framed = [[_framed(o) for o in h] for h in held]
        out_key, out_list = [], []
        if len(there) and len(asked):
            for rows, places, cos in nearest_in_cells(v[asked], v[there], books, k + 1):
                enough, raw = (cos >= least).sum(axis=1).tolist(), cos.astype("<f4")
                groups = there[places]
                for i, n in enumerate(enough):
                    if not n:
                        continue
                    # equal cosines in the order of the keys
                    near = [(-float(raw[i, j]), o, g, m) for j in range(n) for g in (groups[i, j],) for m, o in enumerate(held[g])]
                    if len(near) > 1:
                        near.sort(key=lambda x: x[:2])
                    for key in asking[asked[rows[i]]]:
                        mine = [struct.pack("<f", c) + framed[g][m] for c, o, g, m in near if o != key][:k]
                        if mine:
                            out_key.append(key)
                            out_list.append(b"".join(mine))
        return pa.table({"key": pa.array(out_key, pa.binary()), "near": pa.array(out_list, pa.binary())})

    return work


def _read(blob: bytes) -> Iterator[tuple[float, bytes]]:
    at = 0
    while at < len(blob):
        c, n = struct.unpack_from("<fB", blob, at)
        at += 5
        if not n:
            (n,) = struct.unpack_from("<I", blob, at)
            at += 4
        yield c, blob[at : at + n]
        at += n


def _merge(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a_, b_, cos, rank = [], [], [], []
            for key, lists in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                best: dict[bytes, float] = {}
                for blob in lists:
                    for c, o in _read(blob):
                        best[o] = min(c, best.get(o, 9.0))
                for i, (o, c) in enumerate(sorted(best.items(), key=lambda x: (x[1], x[0]))[:k]):
                    a_.append(id_of(key))
                    b_.append(id_of(o))
                    cos.append(-c)
                    rank.append(i + 1)
            yield pa.RecordBatch.from_arrays([pa.array(a_, pa.string()), pa.array(b_, pa.string()), pa.array(cos, pa.float64()), pa.array(rank, pa.int32())], names=["id", "other", "cosine", "rank"])

    return work


def neighbours(df: DataFrame, k: int = 5, least: float = 0.8, ident: str = "id", vector: str = "vector", seq: Column | None = None) -> DataFrame:
    """(id, other, cosine, rank): for each id its k most similar others with a cosine of ``least`` or more."""
    spark = df.sparkSession
    rows = df.where(F.col(ident).isNotNull()).select(key_of(F.col(ident)).alias("key"), (seq if seq is not None else F.lit("0")).try_cast("long").alias("seq"), valid(F.col(vector)).alias("v"))
    packed = rows.mapInArrow(_pack_batches, "key binary, seq long, code binary")
    latest = packed.groupBy("key").agg(F.max(F.struct("seq", "code")).alias("x")).select("key", F.col("x.code").alias("code")).where("code is not null")
    n = df.count()
    cells = int(min(MOST_CELLS, max(LEAST_CELLS, n // CELL_ROWS)))
    want = min(n, max(CODE_SAMPLE, SAMPLE_A_CELL * cells))
    # a share by hash, which keeps the sample near ``want`` whatever the table's size
    share = 1_000_000 if not n else min(1_000_000, int(1_000_000 * want / n) + 1)
    drawn = rows.where((F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < share) & F.col("v").isNotNull()).select("v").toArrow()
    if drawn.num_rows < 2:
        return spark.createDataFrame([], "id string, other string, cosine double, rank int")
    sample = drawn.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, DIM)
    sample /= np.abs(sample).max(axis=1, keepdims=True)
    sample = (sample / np.linalg.norm(sample, axis=1, keepdims=True)).astype(np.float32)
    cells = min(cells, len(sample))
    centroids = spherical_means(sample, cells)
    books = codebooks(sample[np.random.default_rng(7).permutation(len(sample))[:CODE_SAMPLE]])
    own = np.concatenate([np.argmax(sample[i : i + 2048] @ centroids.T, axis=1) for i in range(0, len(sample), 2048)])
    expected = np.bincount(own, minlength=cells) / len(sample) * n * SPILL
    blocks = np.maximum(1, np.ceil(expected / BLOCK_ROWS)).astype(np.int64)
    shared = spark.sparkContext.broadcast((centroids, blocks))  # 2 MB at most

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, cut_ = shared.value
        spill = min(SPILL, len(c))
        for b in batches:
            for at in range(0, len(b), 1024):
                part = b.slice(at, 1024)
                s = unpack(part.column(1)) @ c.T
                top = np.argpartition(-s, spill - 1, axis=1)[:, :spill]
                row, cell = np.repeat(np.arange(len(part)), spill), top.ravel()
                parts = cut_[cell]
                # a row asks every block of its cell and stands in one of them
                row, cell, many = np.repeat(row, parts), np.repeat(cell, parts), np.repeat(parts, parts)
                block = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                home = np.array([zlib.crc32(k) for k in part.column(0).to_pylist()])[row] % many if many.max(initial=1) > 1 else np.zeros(len(row), dtype=np.int64)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(block.astype(np.int32)), pa.array(block == home), pa.array(np.ones(len(row), dtype=bool)), part.column(0).take(take), part.column(1).take(take)],
                    names=["cell", "block", "base", "asks", "key", "code"],
                )

    spread = latest.mapInArrow(assign, "cell int, block int, base boolean, asks boolean, key binary, code binary")
    lists = spread.groupBy("cell", "block").applyInArrow(_cell(books, k, least), "key binary, near binary")
    return lists.groupBy("key").agg(F.collect_list("near").alias("near")).mapInArrow(_merge(k), "id string, other string, cosine double, rank int")


def pairs(found: DataFrame) -> DataFrame:
    """(id_a, id_b), the smaller id first, of all neighbours."""
    return found.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()
