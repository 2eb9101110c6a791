"""The best documents of weighted term queries, exactly, without meeting every document that holds one of the terms.

Documents lie in blocks, and each block is asked for all queries. In a block, a frequent term is a bitmap of its documents, a bitmap of
those where its count is unusually high, and a level per document; a rare term is a list. The documents with a rare term, with an unusual
count or with all frequent terms are scored first (with most of them, where these are fewer than k). Their k-th score is a bound for the
others: only documents whose terms can add up to it, found by AND and OR of the bitmaps, are scored too. No document that could be among
the best is left out.

Cases: ties at nine digits go to the smaller name, a null name last; a query with fewer than k documents gets all that hold one of its terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A term that one of so many documents of a block holds, or more, is frequent; counts that at most one of so many of them reaches are unusual.
FREQUENT, UNUSUAL = 32, 64
#: Steps over bitmaps that a query may take before all documents with one of its terms are scored.
STEPS = 200
#: Where fewer than k documents have all terms or an unusual count, those of such a share of the bounds are scored first, too.
SHARES = (0.7, 0.45, 0.2)
#: Queries in a batch of results.
QUERIES = 2048


def positions(bits: np.ndarray) -> np.ndarray:
    """The set bits of a bitmap, ascending."""
    words = (bits != 0).nonzero()[0]
    on = np.unpackbits(bits[words].view(np.uint8), bitorder="little").view(bool).nonzero()[0]
    return words[on >> 6] * 64 + (on & 63)


def reaching(bits: list[np.ndarray], bounds: list[float], need: float) -> np.ndarray:
    """A bitmap of all documents whose terms' bounds add up to ``need`` (of others too, where that takes too many steps)."""
    order = sorted(range(len(bits)), key=lambda i: -bounds[i])
    rest = np.cumsum([bounds[i] for i in order[::-1]])[::-1].tolist() + [0.0]
    out, stack, steps = np.zeros_like(bits[0]), [(0, need, None)], 0
    while stack:
        i, left, got = stack.pop()
        if left <= 0 and got is not None:
            np.bitwise_or(out, got, out)
        elif rest[i] >= left and i < len(order):
            steps += 1
            if steps > STEPS:
                return np.bitwise_or.reduce(bits)
            own = bits[order[i]]
            stack += [(i + 1, left, got), (i + 1, left - bounds[order[i]], own if got is None else got & own)]
    return out


class Block:
    """The postings of some documents: a row a document and term."""

    def __init__(self, names: pa.ChunkedArray, tid: np.ndarray, tf: np.ndarray):
        coded = names.dictionary_encode(null_encoding="encode").unify_dictionaries()
        values = coded.chunk(0).dictionary if coded.num_chunks else pa.array([], names.type)
        order = pc.sort_indices(values, null_placement="at_end")
        self.names, self.size = values.take(order), len(values)
        place = np.empty(self.size, np.int64)
        place[order.to_numpy()] = np.arange(self.size)
        doc = place[np.concatenate([c.indices.to_numpy() for c in coded.chunks] or [np.zeros(0, np.int64)])]
        counts, level = np.unique(tf, return_inverse=True)
        #: What a level adds for a term of weight 1; level 0 is a document without the term.
        self.base = np.concatenate([[0.0], 1 + np.log(counts)])
        self.kind = np.min_scalar_type(len(counts))
        tids, term = np.unique(tid, return_inverse=True)
        by = np.argsort(term * max(1, self.size) + doc)
        self.doc, self.level = doc[by], (level[by] + 1).astype(self.kind)
        ends = np.cumsum(np.bincount(term, minlength=len(tids))).tolist()
        self.at = {t: (a, b) for t, a, b in zip(tids.tolist(), [0, *ends], ends, strict=False)}
        self.kept: dict[int, tuple] = {}

    def bitmap(self, docs: np.ndarray) -> np.ndarray:
        flags = np.zeros(-(-self.size // 64) * 64, bool)
        flags[docs] = True
        return np.packbits(flags, bitorder="little").view(np.uint64)

    def term(self, tid: int) -> tuple | None:
        """(documents, levels) of a rare term; (documents' levels, bitmap, bitmap of unusual counts, most that another count adds)."""
        if tid not in self.kept and tid in self.at:
            a, b = self.at[tid]
            docs, level = self.doc[a:b], self.level[a:b]
            if (b - a) * FREQUENT < self.size:
                self.kept[tid] = docs, level
            else:
                every = np.zeros(self.size, self.kind)
                every[docs] = level
                above = len(docs) - np.cumsum(np.bincount(level, minlength=len(self.base)))  # documents above each level
                usual = max(1, int(np.argmax(above * UNUSUAL <= len(docs))))
                self.kept[tid] = every, self.bitmap(docs), self.bitmap(docs[level > usual]), float(self.base[usual])
        return self.kept.get(tid)

    def scores(self, terms: list[tuple], docs: np.ndarray) -> np.ndarray:
        s = np.zeros(len(docs))
        for x, w in terms:
            add = self.base * w
            if len(x) == 4:
                s += add[x[0][docs]]
            else:
                at = np.searchsorted(x[0], docs)
                at[at == len(x[0])] = 0
                s += np.where(x[0][at] == docs, add[x[1][at]], 0.0)
        return s

    def best(self, tids: list[int], weights: list[float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the best k documents and their scores."""
        terms = [(x, w) for t, w in zip(tids, weights, strict=True) if (x := self.term(t))]
        often, rare = [t for t in terms if len(t[0]) == 4], [t[0][0] for t in terms if len(t[0]) == 2]
        docs, bits, bounds = np.zeros(0, np.int64), [x[1] for x, _ in often], [x[3] * w for x, w in often]
        if often:
            seen = bits[0].copy()
            for b in bits[1:]:
                seen &= b
            for x, _ in often:
                seen |= x[2]
            docs = positions(seen)
            for share in SHARES:
                if len(docs) >= k:
                    break
                seen |= reaching(bits, bounds, share * sum(bounds))
                docs = positions(seen)
        if rare:
            docs = np.unique(np.concatenate([docs, *rare]))
        score = self.scores(terms, docs)
        if often:
            need = 0.0
            if len(docs) >= k:
                need = (np.partition(rounded(score), len(docs) - k)[len(docs) - k] - 2) / 1e9
            more = positions((reaching(bits, bounds, need) if need > 0 else np.bitwise_or.reduce(bits)) & ~seen)
            if rare:
                more = np.setdiff1d(more, docs, assume_unique=True)
            if len(more):
                docs, score = np.concatenate([docs, more]), np.concatenate([score, self.scores(terms, more)])
        if len(docs) > k:
            key = rounded(score)
            least = np.partition(key, len(docs) - k)[len(docs) - k]
            above, same = np.flatnonzero(key > least), np.flatnonzero(key == least)
            if len(same) > k - len(above):
                same = same[np.argpartition(docs[same], k - len(above) - 1)[: k - len(above)]]
            take = np.concatenate([above, same])
            docs, score = docs[take], score[take]
        return docs, score


def rounded(score: np.ndarray) -> np.ndarray:
    """Scores at nine digits, as whole numbers."""
    return np.floor(score * 1e9 + 0.5)


def ranker(k: int, out: pa.Schema):
    """For mapInArrow over whole blocks: rows (name, tid, x: count) of documents, and rows (sid, tid, x: weight) of queries, in any order.
    Gives (sid, name, score) of each query's best k of the block. Rows are flat, because Spark measures nested ones at every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts, asks = [], [], []
        for b in batches:
            asked = pc.is_valid(b["sid"])
            asks.append(tuple(c.to_numpy() for c in b.filter(asked).select(["sid", "tid", "x"]).columns))
            b = b.filter(pc.invert(asked))
            names.append(b["name"])
            counts.append((b["tid"].to_numpy(), b["x"].to_numpy()))
        if not names:
            return
        block = Block(pa.chunked_array(names), *map(np.concatenate, zip(*counts, strict=True)))
        sid, tid, weight = map(np.concatenate, zip(*asks, strict=True))
        names, counts, asks = [], [], []
        by = np.lexsort((tid, sid))
        sid, tid, weight = sid[by], tid[by].tolist(), weight[by].tolist()
        sids, starts = np.unique(sid, return_index=True)
        ends = [*starts.tolist(), len(sid)]
        for i in range(0, len(sids), QUERIES):
            found = [block.best(tid[a:b], weight[a:b], k) for a, b in zip(ends[i : i + QUERIES], ends[i + 1 : i + QUERIES + 1], strict=False)]
            own = np.repeat(sids[i : i + QUERIES], [len(d) for d, _ in found])
            docs, score = (np.concatenate([x[j] for x in found]) for j in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), block.names.take(pa.array(docs, pa.int64())), pa.array(score, pa.float64())], schema=out)

    return work
