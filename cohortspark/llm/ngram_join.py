"""N-gram Jaccard self-join through groups of similar texts and their token unions.

A text's set is its distinct shingles of ``SHINGLE`` words; texts with equal sets are one node.
Two nodes link when 100 |A and B| >= ``PERCENT`` |A or B|.

1. *Blocks.*  For sizes that can link, at most d tokens lie outside the intersection, so if tokens
   are dealt by hash into more than d parts, linked sets agree in at least one whole part.  Every
   node lists one signature per part; nodes with a common signature are a block.  With e parts to
   spare, a node may leave out up to e parts of at most ``SMALL`` tokens, which keeps texts that
   only share a common phrase apart.  Sizes that allow one token of difference at most use the
   sets without one token instead.  Signatures are shuffled once and sorted, and a task streams
   through the runs, so a block is never held; a signature has at most one row per node, and a
   node as many signatures as parts, so no key holds more than a small share of the rows.
   Below ``PERCENT`` parts would be so small that unrelated texts agree in many of them; there, a
   node's signatures are its n - ceil(percent n) + 1 rarest tokens, of which linked sets share one
   whatever the order of tokens.  The order is taken from a sketch of ``SKETCH`` counters over
   all texts, so a token that many texts share seldom is a signature.
2. *Groups.*  A block's centre is its node with the largest blocks, which for copies of one text
   tends to be that text.  Every node is compared with the centre it shares most blocks with;
   components of these links partition similar texts into groups.
3. *Queries.*  All nodes of blocks with the same centre that still hold several groups form a
   cluster, stored in chunks of about ``CHUNK_TOKENS`` tokens with the union of the members'
   tokens.  Only nodes outside the centre's group query it.  A chunk is opened only if
   |query and union| >= PERCENT % |query|, which every link needs; the members of an opened chunk
   are compared exactly by one lookup of the query's tokens.  A chunk reports a link only if it
   joins groups that its links have not joined yet, so no pairs inside a group are made.

Steps 2 and 3 first run on histograms of hashed tokens (about a bit a token) instead of texts.
Two sets differ in at least as many tokens as their histograms do, and share at most the sum of
their cells' minima, which bounds |A and B| from above, also against the union (the maxima) of a
chunk's histograms.  Texts are fetched only for the queries and members that some bound lets
through, and compared exactly.

Before texts are shuffled for a comparing step, a bitmap of fixed size (hashes of the wanted
texts) drops nearly all that are not wanted; the join that follows is exact.

Cases: null or empty text has no shingles and is its own component; a text of one or two words
has one shingle; equal sets are linked whatever their ids; repeated rows get one row each; null
ids never are the smallest of a component unless there is no other; an empty table gives no rows;
only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bound_batches, materialize, shuffle_partitions, tidy
from .components import connected_components
from .textnp import Words, mix, text_chunks, windows

SHINGLE, PERCENT = 3, 90
SMALL = 2
CHUNK_TOKENS = 1_000_000
QUERIES = 2_000
BITMAP_BITS = 1 << 26
SCREEN_CELLS = 1 << 21
FULL = 15
SKETCH, SKETCH_PARTS = 1 << 20, 64


# --- sets ------------------------------------------------------------------------------------

def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(tokens sorted within each row, bounds of the rows): distinct shingle hashes per row."""
    words = Words(data, offs, lower=True)
    h = words.hashes()
    at, tok = windows(h, words.first, words.count, size)
    doc = words.doc[at]
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    if len(short):  # the whole sequence is the shingle
        whole = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            more = words.count[short] > k
            whole[more] = mix(whole[more] * np.uint64(3) + h[words.first[short[more]] + k] + np.uint64(k + 1))
        doc, tok = np.concatenate([doc, short]), np.concatenate([tok, whole])
    order = np.lexsort((tok, doc))
    doc, tok = doc[order], tok[order]
    new = np.ones(len(tok), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tok[1:] != tok[:-1])
    doc, tok = doc[new], tok[new]
    return tok, np.searchsorted(doc, np.arange(len(offs)))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def histograms(tok: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Histogram of every row's tokens over a power of two of cells, 32 and one for every 8 tokens
    at least, two cells a byte.  A token's cell is the low end of its hash, so the sum of the halves
    is the histogram over half the cells.  Counts end at FULL; a sum that ends there as well is the
    same as if only the sum had been ended, so bounds stay right."""
    n = np.diff(bounds)
    cells = np.where(n > 0, np.maximum(32, 1 << np.ceil(np.log2(np.maximum(n / 8, 1))).astype(np.int64)), 0)
    start = np.concatenate([[0], np.cumsum(cells)])
    cell = mix(tok ^ np.uint64(0x165667B19E3779F9)) & np.repeat(cells - 1, n).astype(np.uint64)
    count = np.bincount(np.repeat(start[:-1], n) + cell.astype(np.int64), minlength=int(start[-1]))
    count = np.minimum(count, FULL).astype(np.uint8)
    data = count[::2] | count[1::2] << 4
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((start // 2).astype(np.int32)), pa.py_buffer(data)])


# --- signatures ------------------------------------------------------------------------------

def largest_partner(n: int, percent: int = PERCENT) -> int:
    return 100 * n // percent


class Scheme:
    """Parts for pairs whose smaller set has ``low`` to ``high`` tokens."""

    def __init__(self, number: int, low: int, high: int, percent: int):
        self.number, self.low, self.high = number, low, high
        self.partner = largest_partner(high, percent)
        # d = a + b - 2 i with i >= percent (a + b) / (100 + percent)
        need = (high + self.partner) * (100 - percent) // (100 + percent) + 1
        self.spare = 1 + need // 12
        self.parts = need + self.spare


def tiny_sizes(percent: int = PERCENT) -> tuple[int, int]:
    """Least and largest size of the smaller set for which one token of difference is allowed
    and no more; below, only equal sets link."""
    allowed = lambda a: (a + largest_partner(a, percent)) * (100 - percent) // (100 + percent)
    low = next(a for a in range(1, 101) if allowed(a) >= 1)
    return low, next(a for a in range(low, 1001) if allowed(a + 1) > 1)


def schemes(largest: int, percent: int = PERCENT) -> list[Scheme]:
    """Schemes for pairs of all sizes above the tiny ones and up to ``largest``."""
    out, low = [], tiny_sizes(percent)[1] + 1
    while low <= largest:
        high = low * 3 // 2
        out.append(Scheme(len(out) + 1, low, high, percent))
        low = high + 1
    return out


def signatures(tok: np.ndarray, bounds: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) pairs, rows ascending."""
    n = np.diff(bounds)
    rows, sigs = [], []

    def tokens_of(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the chosen rows' tokens, and the number of the row among the chosen."""
        size = n[chosen]
        start = np.cumsum(size) - size
        local = np.repeat(np.arange(len(chosen)), size)
        return np.arange(int(size.sum())) + np.repeat(bounds[chosen] - start, size), local

    least, upto = tiny_sizes(percent)
    tiny = np.flatnonzero((n >= least) & (n <= largest_partner(upto, percent)))
    if len(tiny):
        at, local = tokens_of(tiny)
        value = mix(tok[at])
        whole = _sums(value, np.concatenate([[0], np.cumsum(n[tiny])]))
        size = n[tiny].astype(np.uint64)
        rows += [tiny, tiny[local]]
        sigs += [mix(whole + size), mix(whole[local] - value + size[local] - np.uint64(1))]
    for s in schemes(int(n.max(initial=0)), percent):
        chosen = np.flatnonzero((n >= s.low) & (n <= s.partner))
        if not len(chosen):
            continue
        at, local = tokens_of(chosen)
        value = mix(tok[at] ^ mix(np.full(1, s.number, np.uint64)))
        part = ((value >> np.uint64(32)) % np.uint64(s.parts)).astype(np.int64)
        cell = local * s.parts + part
        cells = len(chosen) * s.parts
        value = mix(value + np.uint64(1))
        low = np.bincount(cell, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), cells).astype(np.uint64)
        high = np.bincount(cell, (value >> np.uint64(32)).astype(np.float64), cells).astype(np.uint64)
        count = np.bincount(cell, minlength=cells).reshape(-1, s.parts)
        small = count <= SMALL
        emit = ~small | (small.sum(axis=1) > s.spare)[:, None]
        where = np.arange(s.parts, dtype=np.uint64) + np.uint64(s.number << 40)
        sig = mix(low + mix(high + mix(np.tile(where, len(chosen)))))
        rows.append(np.repeat(chosen, s.parts)[emit.ravel()])
        sigs.append(sig[emit.ravel()])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row, sig = np.concatenate(rows), np.concatenate(sigs)
    order = np.argsort(row, kind="stable")
    return row[order], sig[order]


# --- rare tokens -----------------------------------------------------------------------------

def _cell(tok: np.ndarray) -> np.ndarray:
    return (mix(tok ^ np.uint64(0x27D4EB2F165667C5)) & np.uint64(SKETCH - 1)).astype(np.int64)


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for _, _, data, offs in text_chunks(batch.column(0)):
                cell, n = np.unique(_cell(shingle_sets(data, offs, size)[0]), return_counts=True)
                counts[cell] += n
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_PARTS), pa.int32()),
                                              pa.array([x.tobytes() for x in np.split(counts, SKETCH_PARTS)])], names=["part", "counts"])
    return run


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = total.setdefault(part, np.zeros(SKETCH // SKETCH_PARTS, np.int64))
            own += np.frombuffer(raw, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                     names=["part", "counts"])


def token_frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """Rank by frequency (a byte: eighths of the logarithm) of every cell of a fixed-size sketch."""
    kind = "part int, counts binary"
    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidy(_sketch(size)), kind)
    out = np.zeros(SKETCH, np.int64)
    for r in parts.repartition(SKETCH_PARTS, "part").mapInArrow(_sum_parts, kind).collect():  # SKETCH counters in all
        step = SKETCH // SKETCH_PARTS
        out[r["part"] * step:(r["part"] + 1) * step] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(8 * np.log2(out + 1), 255).astype(np.uint8)


def rare_tokens(tok: np.ndarray, bounds: np.ndarray, percent: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, token) of every row's n - ceil(percent n / 100) + 1 rarest tokens, rows ascending."""
    n = np.diff(bounds)
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((tok, ranks[_cell(tok)], row))
    nth = np.arange(len(tok)) - np.repeat(bounds[:-1], n)
    first = nth < np.repeat(n - -(-percent * n // 100) + 1, n)
    return row[first], mix(tok[order[first]])


def _describe(size: int, percent: int, ranks=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column(2)):
                tok, bounds = shingle_sets(data, offs, size)
                row, sig = signatures(tok, bounds, percent) if ranks is None else rare_tokens(tok, bounds, percent, ranks.value)
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)),
                                                 pa.array(sig.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(np.diff(bounds)),
                     pa.array(_sums(mix(tok * np.uint64(0x9E3779B97F4A7C15)), bounds).view(np.int64)),
                     pa.array(_sums(mix(tok ^ np.uint64(0xC2B2AE3D27D4EB4F)), bounds).view(np.int64)), lists,
                     histograms(tok, bounds)],
                    names=["doc_id", "text_key", "n", "s1", "s2", "sigs", "hist"])
    return run


def described(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """row, doc_id, text_key, n, s1, s2 (128-bit set signature), sigs, hist; a written table."""
    bound_batches(docs.sparkSession)
    texts = _texts(docs).select("doc_id", "text_key", "text")
    ranks = None if percent >= PERCENT else docs.sparkSession.sparkContext.broadcast(token_frequencies(docs, size))
    out = texts.mapInArrow(tidy(_describe(size, percent, ranks)),
                           "doc_id long, text_key long, n long, s1 long, s2 long, sigs array<long>, hist binary")
    return materialize(out.withColumn("row", F.monotonically_increasing_id()), "join-sets")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (sig, node) sorted by sig, those whose sig has several rows."""
    last = None  # a row that is alone in its run so far, held back
    before = None  # the signature of the last row
    for batch in batches:
        sig, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(sig):
            continue
        if last is not None:
            sig, node = np.concatenate([[last[0]], sig]), np.concatenate([[last[1]], node])
        head = np.ones(len(sig), bool)
        head[1:] = sig[1:] != sig[:-1]
        if last is None and sig[0] == before:
            head[0] = False  # goes on from the last batch
        emit = ~head | ~np.append(head[1:], True)
        before = sig[-1]
        last = None
        if head[-1]:
            last, emit[-1] = (sig[-1], node[-1]), False
        yield pa.RecordBatch.from_arrays([pa.array(x[emit]) for x in (sig, node)], names=["sig", "node"])


# --- screening -------------------------------------------------------------------------------

def _folded(cells: np.ndarray, width: int) -> np.ndarray:
    while cells.shape[1] > width:
        half = cells.shape[1] // 2
        cells = np.minimum(cells[:, :half] + cells[:, half:], FULL)
    return cells


class Shelf:
    """Histograms of several nodes, in one matrix per number of cells."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, hists: list[bytes]):
        self.rows = len(hists)
        width = np.array([len(h) for h in hists], np.int64)
        self.classes = []  # (numbers of the nodes, their n, comp, matrix, its maxima)
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            packed = np.frombuffer(b"".join(hists[k] for k in at), np.uint8).reshape(len(at), w)
            m = np.stack([packed & 15, packed >> 4], axis=2).reshape(len(at), 2 * w)
            self.classes.append((at, n[at], comp[at], m, m.max(axis=0)[None, :]))


def screen(asks: Shelf, members: Shelf, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which queries, and which members, may have a link with one of another component."""
    ask_hit, member_hit = np.zeros(asks.rows, bool), np.zeros(members.rows, bool)
    for at_a, n_a, comp_a, m_a, _ in asks.classes:
        for at_b, n_b, comp_b, m_b, union in members.classes:
            if 100 * n_a.max() < percent * n_b.min() or 100 * n_b.max() < percent * n_a.min():
                continue
            width = min(m_a.shape[1], m_b.shape[1])
            a, b, u = _folded(m_a, width), _folded(m_b, width), _folded(union, width)
            # tokens beyond the ended counts may be shared, so they stay in the bounds
            past_a, past_b = n_a - a.sum(axis=1, dtype=np.int64), n_b - b.sum(axis=1, dtype=np.int64)
            inside = past_a + np.minimum(a, u).sum(axis=1, dtype=np.int64)
            open_ = np.flatnonzero(100 * inside >= percent * n_a)
            step = max(1, SCREEN_CELLS // b.size)
            for lo in range(0, len(open_), step):
                q = open_[lo:lo + step]
                both = np.minimum(a[q, None, :], b[None, :, :]).sum(axis=2, dtype=np.int64)
                most = both + np.minimum(past_a[q, None], past_b[None, :])
                fits = ((100 + percent) * most >= percent * (n_a[q, None] + n_b[None, :])) & (comp_a[q, None] != comp_b[None, :])
                ask_hit[at_a[q]] |= fits.any(axis=1)
                member_hit[at_b] |= fits.any(axis=0)
    return ask_hit, member_hit


def _screen(percent: int):
    """Of rows (grp, part, side, node, comp, asks, n, hist) sorted by grp, part and side, those to open."""
    names = ["grp", "part", "side", "node", "comp"]

    def batch_of(key: tuple, side: int, node: np.ndarray, comp: np.ndarray) -> pa.RecordBatch:
        full = [np.full(len(node), key[0], np.int64), np.full(len(node), key[1], np.int32), np.full(len(node), side, np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*full, node, comp)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, shelf, hit = None, [], None, None  # rows: the chunk's members as they come

        def close():
            """The members are complete: those that ask are compared with the others."""
            node, comp, asks, n = (np.concatenate([r[k] for r in rows]) for k in range(4))
            hists = [h for r in rows for h in r[4]]
            shelf = Shelf(n, comp, hists)
            who = np.flatnonzero(asks)
            hit, out = np.zeros(len(node), bool), []
            if len(who):
                found, hit = screen(Shelf(n[who], comp[who], [hists[k] for k in who]), shelf, percent)
                out = [(1, node[who[found]], comp[who[found]])]
            return (node, comp, shelf), hit, out

        def finish():
            nonlocal shelf, hit
            out = []
            if rows and shelf is None:
                shelf, hit, out = close()
            if shelf is not None:
                out.append((0, shelf[0][hit], shelf[1][hit]))
            return [batch_of(key, *x) for x in out if len(x[1])]

        for batch in batches:
            grp, part, side, node, comp = (batch.column(k).to_numpy() for k in range(5))
            asks, n = batch.column(5).to_numpy(zero_copy_only=False), batch.column(6).to_numpy()
            if not len(grp):
                continue
            cut = np.flatnonzero((grp[1:] != grp[:-1]) | (part[1:] != part[:-1]) | (side[1:] != side[:-1])) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(grp)]):
                if (grp[lo], part[lo]) != key:
                    yield from finish()
                    key, rows, shelf, hit = (grp[lo], part[lo]), [], None, None
                piece = slice(lo, hi)
                values = node[piece], comp[piece], asks[piece], n[piece], batch.column(7).slice(lo, hi - lo).to_pylist()
                if side[lo] == 0:
                    rows.append(values)
                    continue
                if shelf is None and rows:
                    shelf, hit, out = close()
                    yield from (batch_of(key, *x) for x in out if len(x[1]))
                if shelf is None:
                    continue
                found, more = screen(Shelf(values[3], values[1], values[4]), shelf[2], percent)
                hit |= more
                if found.any():
                    yield batch_of(key, 1, values[0][found], values[1][found])
        yield from finish()
    return run


def screened(need: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """grp, part, side, node, comp of the rows of ``need`` (grp, part, side, node, comp, asks) that
    the histograms do not rule out: members (side 0), queries from outside their chunk (side 1) and,
    as queries, members that ask."""
    hists = sets.select(F.col("row").alias("node"), "n", "hist")
    rows = (need.join(hists, "node").select("grp", "part", "side", "node", "comp", "asks", "n", "hist")
            .repartition("grp", "part").sortWithinPartitions("grp", "part", "side"))
    return rows.mapInArrow(tidy(_screen(percent)), "grp long, part int, side int, node long, comp long")


# --- comparing -------------------------------------------------------------------------------

class Chunk:
    """Members of one cluster chunk: their tokens in one sorted array with the member's number."""

    def __init__(self):
        self.sets: list[np.ndarray] = []
        self.nodes: list[int] = []
        self.groups: list[int] = []
        self.parent: dict[int, int] = {}
        self.sorted = None

    def add(self, node: int, group: int, tokens: np.ndarray) -> None:
        self.nodes.append(node)
        self.groups.append(group)
        self.sets.append(tokens)

    def _close(self) -> None:
        flat = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        self.size = np.array([len(s) for s in self.sets], np.int64)
        order = np.argsort(flat, kind="stable")
        self.sorted = flat[order]
        self.member = np.repeat(np.arange(len(self.sets)), self.size)[order]
        self.union, self.first = np.unique(self.sorted, return_index=True)
        self.first = np.append(self.first, len(self.sorted))
        self.group = np.array(self.groups, np.int64)
        self.sets = []

    def _root(self, group: int) -> int:
        while (up := self.parent.get(group, group)) != group:
            group = up
        return group

    def links(self, group: int, query: np.ndarray, percent: int) -> list[int]:
        """Members that link with the query set, one for each group that is not yet joined with
        the query's; none if the union's overlap keeps the chunk closed."""
        if self.sorted is None:
            self._close()
        if not len(self.union):
            return []
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        at = at[self.union[at] == query]
        if 100 * len(at) < percent * len(query):
            return []
        count = self.first[at + 1] - self.first[at]
        take = np.arange(int(count.sum())) + np.repeat(self.first[at] - (np.cumsum(count) - count), count)
        common = np.bincount(self.member[take], minlength=len(self.nodes))
        good = np.flatnonzero((100 * common >= percent * (len(query) + self.size - common)) & (self.group != group))
        out = []
        for other, k in zip(*np.unique(self.group[good], return_index=True)):
            a, b = self._root(int(other)), self._root(group)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                out.append(self.nodes[good[k]])
        return out


def _compare(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunk = None, Chunk()
        for batch in batches:
            cluster, part, side, node, group = (batch.column(k).to_numpy() for k in range(5))
            found = []
            for lo, hi, data, offs in text_chunks(batch.column(5)):
                tok, bounds = shingle_sets(data, offs, size)
                for k in range(lo, hi):
                    if (cluster[k], part[k]) != key:
                        key, chunk = (cluster[k], part[k]), Chunk()
                    own = tok[bounds[k - lo]:bounds[k - lo + 1]]
                    if side[k] == 0:
                        chunk.add(int(node[k]), int(group[k]), own)
                    else:
                        found += [(int(node[k]), other) for other in chunk.links(int(group[k]), own, percent)]
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def wanted_bits(need: DataFrame) -> np.ndarray:
    """Bitmap of the wanted texts' keys; BITMAP_BITS bits whatever the input."""
    bit = F.pmod("text_key", F.lit(BITMAP_BITS)) + 1  # Spark's bitmap buckets count from 1
    rows = (need.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    every = np.zeros((BITMAP_BITS // 32768 + 1, 4096), np.uint8)
    for r in rows:
        every[r["bucket"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return every[1:].ravel()


def by_bitmap(rows: DataFrame, key: str, need: DataFrame, listed: bool = True) -> DataFrame:
    """Rows whose key may be (or, not ``listed``, is certainly not) a text_key of ``need``."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted_bits(need))
    names = rows.columns
    at_key = names.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            at = batch.column(at_key).to_numpy() % BITMAP_BITS
            kept = batch.filter(pa.array((bits[at >> 3] >> (at & 7) & 1) == listed))
            yield pa.RecordBatch.from_arrays(kept.columns, names=names)
    return rows.mapInArrow(tidy(run), rows.schema)


def open_groups(docs: DataFrame, need: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between queries (side 1) and members (side 0) of the same (grp, part);
    ``need`` has grp, part, side, node, the node's group comp, and its doc_id and text_key."""
    texts = _texts(docs).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "text")
    texts = by_bitmap(texts, "__key", need)
    rows = (need.join(texts, need["doc_id"].eqNullSafe(texts["__id"]) & (need["text_key"] == texts["__key"]))
            .select("grp", "part", "side", "node", "comp", "text")
            .repartition("grp", "part").sortWithinPartitions("grp", "part", "side", "node"))
    return rows.mapInArrow(tidy(_compare(size, percent)), "a long, b long")


def _pick(node: str, of: str):
    return F.pmod(F.xxhash64(node), F.col(of)).cast("int")


# --- the join --------------------------------------------------------------------------------

def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key, row and kept (true for one row of every
    component: that of the smallest doc_id) for every row of ``docs``."""
    sets = described(docs, size, percent)
    ids = sets.select("row", "doc_id", "text_key", "n", "s1", "s2")
    nodes = materialize(ids.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("row").alias("node")), "join-nodes")
    place = ids.join(nodes.select("node"), ids["row"] == nodes["node"], "left_semi") \
        .select(F.col("row").alias("node"), "doc_id", "text_key", "n")
    place = materialize(place, "join-places")

    # 1. blocks: signatures that several nodes share
    copies = materialize(ids.where("n > 0").select("row").join(nodes, F.col("row") == F.col("node"), "left_anti"), "join-copies")
    every = (sets.select(F.col("row").alias("node"), "sigs").where(F.size("sigs") > 0)
             .join(copies, F.col("node") == F.col("row"), "left_anti").select(F.explode("sigs").alias("sig"), "node"))
    every = every.repartition(shuffle_partitions(docs.sparkSession), "sig").sortWithinPartitions("sig")
    blocks = materialize(every.mapInArrow(tidy(_runs), "sig long, node long"), "join-blocks")

    # 2. groups: every node against the centre it shares most blocks with
    sizes = blocks.groupBy("sig").agg(F.count("*").alias("k"))
    weight = blocks.join(sizes, "sig").groupBy("node").agg(F.sum("k").alias("weight"))
    weight = materialize(weight, "join-weights")
    centers = (blocks.join(weight, "node").groupBy("sig")
               .agg(F.max(F.struct("weight", (-F.col("node")).alias("c"))).alias("best"))
               .select("sig", (-F.col("best.c")).alias("grp")))
    blocks = materialize(blocks.join(centers, "sig"), "join-centres")
    star = blocks.where("node <> grp").groupBy("node", "grp").agg(F.count("*").alias("k"))
    star = star.groupBy("node").agg(F.max(F.struct("k", (-F.col("grp")).alias("c"))).alias("best")) \
        .select("node", (-F.col("best.c")).alias("grp"))
    star = materialize(star, "join-stars")
    salted = star.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(float(QUERIES))).cast("int").alias("of"))
    asks = star.join(salted, "grp").select("grp", _pick("node", "of").alias("part"), F.lit(1).alias("side"), "node")
    members = salted.select("grp", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("part"),
                            F.lit(0).alias("side"), F.col("grp").alias("node"))
    need = asks.unionAll(members).withColumns({"comp": F.col("node"), "asks": F.lit(False)})
    need = materialize(screened(need, sets, percent), "join-open").join(place, "node")
    links = materialize(open_groups(docs, materialize(need, "join-need"), size, percent), "join-links")

    # 3. queries in the clusters of blocks that still hold several groups
    comps = materialize(connected_components(links), "join-groups")
    labelled = blocks.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = labelled.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    clusters = labelled.join(mixed.select("sig"), "sig", "left_semi").select("grp", "node", "comp").distinct()
    clusters = materialize(clusters.join(place.select("node", "n"), "node"), "join-clusters")
    chunks = clusters.groupBy("grp").agg(F.ceil(F.sum("n") / F.lit(float(CHUNK_TOKENS))).cast("int").alias("of"))
    main = clusters.where("node = grp").select("grp", F.col("comp").alias("main"))
    clusters = (clusters.join(chunks, "grp").join(main, "grp", "left")
                .withColumns({"own": _pick("node", "of"), "asks": F.expr("main is null or comp <> main")}))
    members = clusters.select("grp", F.col("own").alias("part"), F.lit(0).alias("side"), "node", "comp", "asks")
    asks = (clusters.where("asks and of > 1").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
            .where("part <> own").select("grp", "part", F.lit(1).alias("side"), "node", "comp", "asks"))
    need = materialize(screened(members.unionAll(asks), sets, percent), "join-open").join(place, "node")
    more = materialize(open_groups(docs, materialize(need, "join-need"), size, percent), "join-links")

    # components of all links, named by their smallest doc_id
    comps = connected_components(links.unionAll(more))
    rows = ids.join(nodes, ["n", "s1", "s2"], "left").select("row", "doc_id", "text_key", "n", F.coalesce("node", "row").alias("node"))
    rows = rows.join(comps, "node", "left").select("row", "doc_id", "text_key", "n", F.coalesce("comp", "node").alias("comp"))
    rows = materialize(rows, "join-rows")
    names = rows.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.min(
        F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("first_row"))
    names = materialize(names, "join-names")
    return rows.join(names, "comp").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_key", "row",
                                           (F.col("row") == F.col("first_row")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one of every component, with all their columns.

    Kept rows are found again by doc_id and text; rows that agree in both are repeats of one row,
    of which one is taken.  Rows that a bitmap shows to be unlisted are passed on as they are read;
    only the rest is joined."""
    found = jaccard_components(docs, size, percent)
    gone = (found.groupBy("doc_id", "text_key").agg(F.max(F.col("kept").cast("int")).alias("any"), F.count("*").alias("n"))
            .where("any = 0 or n > 1"))
    gone = materialize(gone.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("any").alias("__any")),
                       "join-gone")
    keyed = docs.withColumn("__mine", F.xxhash64(F.col("text").cast("string")))
    wanted = gone.select(F.col("__key").alias("text_key"))
    untouched = by_bitmap(keyed, "__mine", wanted, listed=False)
    keyed = by_bitmap(keyed, "__mine", wanted)
    match = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__mine") == F.col("__key"))
    single = keyed.join(gone, match, "left_anti")
    repeated = keyed.join(gone.where("__any = 1"), match, "left_semi")
    first = F.row_number().over(W.partitionBy("doc_id", "__mine").orderBy(F.lit(0)))
    repeated = repeated.withColumn("__nth", first).where("__nth = 1").drop("__nth")
    return untouched.unionAll(single).unionAll(repeated).drop("__mine")
