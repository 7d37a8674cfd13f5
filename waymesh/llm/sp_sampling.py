"""Distinct sampled segmentations with a SentencePiece vocabulary, by Gumbel top-k.

The lattice of a text has an edge for every vocabulary piece that matches. A piece's
probability falls with its rank in the vocabulary, ``1 / (rank + 2)`` to the power
``sharpness``; a segmentation's is proportional to the product. Adding an independent Gumbel
variable to each log-probability and taking the k largest draws k segmentations without
replacement. They are found by A* search over sets of segmentations that share a beginning:
a set's largest perturbed value is drawn at once from its total mass, the best set is opened,
its best member is drawn forward through the lattice, and what is left of the set falls
apart into sets along that path, whose largest values are drawn below the member's. As the
bound of a set is the value itself, no set is opened in vain.

Pieces never cross the beginning of a run of blanks, so the lattice is a chain of chunks, and
the sums over a chunk's endings are kept for chunks that come again. All texts of a batch
take a step together. Random numbers come from a hash of the row's key, the sample, the chunk
and the step: the same row gives the same samples wherever and beside whatever it is drawn.

A sample has its log-probability, its perturbed value, and its inclusion score
1 - exp(-exp(log_prob - next)), with the perturbed value of the best segmentation not drawn:
the probability of being drawn given that threshold, for importance weights. If all
segmentations are drawn it is 1.

Decoding is exact: characters outside the vocabulary, and the mark that stands for a blank
if a text holds it, are encoded as bytes.

Defined cases: a null or empty text has one segmentation, the empty one. A text with fewer
than k segmentations gives all it has. A null key is a key like others; repeated rows give
the same samples. Extra columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import gc
import heapq
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CHUNK = re.compile(" *[^ ]+| +")
#: The same, but a chunk that starts with ASCII letters ends with them before other ASCII characters.
FINE_CHUNK = re.compile(r" *[A-Za-z]+(?=[\x00-@\[-`{-\x7f])| *[^ ]+| +")
#: Longer chunks are taken one at a time.
SHORT = 64
#: Texts that take steps together; lattice edges that are kept at hand.
BATCH_DOCS, BATCH_CHARS, KEPT_EDGES = 256, 2_000_000, 5_000_000
BYTE_LOG = -14.0
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def uniform(seed: np.ndarray, *parts: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) from a hash of the arguments."""
    x = np.atleast_1d(seed).astype(np.uint64)
    for k, p in enumerate(parts):
        x = (x ^ (np.atleast_1d(p).astype(np.uint64) + np.uint64(k + 1)) * _MIX[3]) * _MIX[0]
        x ^= x >> np.uint64(29)
        x *= _MIX[1]
        x ^= x >> np.uint64(32)
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


def rolled(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of strings with one more character."""
    x = (hashes ^ (codes.astype(np.uint64) + np.uint64(1)) * _MIX[3]) * _MIX[0]
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Pieces of a SentencePiece model and their log-probabilities."""

    def __init__(self, model: str, sharpness: float = 1.0):
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor(model_file=model)
        self.size, self.log, self.bytes, self.byte_id = read.vocab_size(), {}, [b""] * read.vocab_size(), [0] * 256
        rank = 0
        for k in range(self.size):
            piece = read.id_to_piece(k)
            if read.is_byte(k):
                value = int(piece[3:5], 16)
                self.byte_id[value], self.bytes[k] = k, bytes([value])
            elif not (read.is_control(k) or read.is_unknown(k) or read.is_unused(k)):
                plain = piece.replace(MARK, " ")
                self.log[plain] = (k, -sharpness * math.log(rank + 2))
                self.bytes[k] = plain.encode()
                rank += 1
        self.longest = max(map(len, self.log), default=1)
        self.tables = self._tables()
        if any(re.search("[^ ] ", x) for x in self.log):
            raise ValueError(f"{model}: a piece with a blank inside would cross the chunks")
        # pieces that run from a Latin letter on to another ASCII character would join chunks
        self.joins = any(re.search("[A-Za-z][\\x00-@\\[-`{-\\x7f]", x) for x in self.log)

    def _tables(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By length: hashes, ascending, of the pieces and the beginnings of pieces; the piece's
        number or -1; its log-probability; whether a longer piece begins so."""
        found: list[dict[str, tuple[int, float]]] = [{} for _ in range(self.longest)]
        longer: set[str] = set()
        for text, (k, x) in self.log.items():
            found[len(text) - 1][text] = (k, x)
            for n in range(1, len(text)):
                longer.add(text[:n])
        for text in longer:
            found[len(text) - 1].setdefault(text, (-1, 0.0))
        tables = []
        for n, strings in enumerate(found, 1):
            codes = np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32).reshape(-1, n)
            hashes = np.zeros(len(codes), dtype=np.uint64)
            for k in range(n):
                hashes = rolled(hashes, codes[:, k])
            order = np.argsort(hashes)
            assert len(np.unique(hashes)) == len(hashes), "two pieces have one hash"
            values = list(strings.items())
            pick = lambda f: np.array([f(values[i]) for i in order])
            tables.append((hashes[order], pick(lambda v: v[1][0]).astype(np.int64), pick(lambda v: v[1][1]).astype(np.float64), pick(lambda v: v[0] in longer).astype(bool)))
        return tables

    def decode(self, ids: np.ndarray) -> bytes:
        made = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return made[1:] if made[:1] == b" " else made

    def symbols(self, symbol: np.ndarray) -> np.ndarray:
        """Ids of lattice symbols: pieces as they are, characters as their bytes."""
        if not len(symbol) or symbol.max() < self.size:
            return symbol.astype("<u4")
        plain = symbol < self.size
        if symbol[~plain].max() < self.size + 128:  # ASCII: one byte each
            return np.where(plain, symbol, np.array(self.byte_id)[np.where(plain, 0, symbol - self.size)]).astype("<u4")
        out: list[int] = []
        for s in symbol.tolist():
            out += [s] if s < self.size else [self.byte_id[b] for b in chr(s - self.size).encode("utf-8", "replace")]
        return np.array(out, dtype="<u4")


class Lattices:
    """Rows of choices, one for each position of each chunk: the edges from there with their
    conditional log-probabilities, cumulated for drawing, and the rows they lead to."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.first: dict[str, int] = {}
        self.start, self.upto, self.log, self.symbol, self.next = array("q"), array("d"), array("d"), array("q"), array("q")

    def add(self, chunks: list[str]) -> None:
        """Rows for chunks not met before: all short ones together, a length at a time
        forwards and a distance from the end at a time backwards."""
        short = [c for c in chunks if len(c) <= SHORT]
        for c in chunks:
            if len(c) > SHORT:
                self.add_long(c)
        if not short:
            return
        v, base, offset = self.vocabulary, len(self.start), len(self.upto)
        codes = np.frombuffer("".join(short).encode("utf-32-le"), dtype=np.uint32)
        sizes = np.array([len(c) for c in short])
        ends = np.repeat(np.cumsum(sizes), sizes)
        at, hashes = np.arange(len(codes)), np.zeros(len(codes), dtype=np.uint64)
        parts = []
        for n, (known, piece, log, more) in enumerate(v.tables, 1):
            inside = at + n <= ends[at]
            at, hashes = at[inside], hashes[inside]
            if not len(at) or not len(known):
                break
            hashes = rolled(hashes, codes[at + n - 1])
            k = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            same = known[k] == hashes
            is_piece = same & (piece[k] >= 0)
            parts.append((at[is_piece], at[is_piece] + n, piece[k[is_piece]], log[k[is_piece]]))
            if n == 1:
                lone = at[~is_piece]
                parts.append((lone, lone + 1, v.size + codes[lone].astype(np.int64), np.full(len(lone), BYTE_LOG)))
            on = same & more[k]
            at, hashes = at[on], hashes[on]
        source, target, symbol, log = (np.concatenate([p[c] for p in parts]) for c in range(4))
        order = np.lexsort((target, source))
        source, target, symbol, log = source[order], target[order], symbol[order], log[order]
        last = target == ends[source]
        ending, value = np.zeros(len(codes)), np.zeros(len(source))
        left = (ends - np.arange(len(codes)))[source]  # distance from the end
        by = np.argsort(left, kind="stable")
        bounds = np.searchsorted(left[by], np.arange(1, int(left.max()) + 2))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            e = by[a:b]
            x = log[e] + np.where(last[e], 0.0, ending[np.minimum(target[e], len(codes) - 1)])
            heads = np.flatnonzero(np.concatenate(([True], source[e[1:]] != source[e[:-1]])))
            most = np.maximum.reduceat(x, heads)
            counts = np.diff(np.append(heads, len(e)))
            total = most + np.log(np.add.reduceat(np.exp(x - np.repeat(most, counts)), heads))
            ending[source[e[heads]]] = total
            value[e] = np.where(np.repeat(counts, counts) == 1, 0.0, x - np.repeat(total, counts))
        heads = np.searchsorted(source, np.arange(len(codes)))
        summed = np.cumsum(np.exp(value))
        upto = base + source + summed - np.where(heads > 0, summed[heads - 1], 0.0)[source]
        upto[np.append(heads[1:], len(source)) - 1] = base + np.arange(len(codes)) + 1.0
        self.start.frombytes((offset + heads).astype(np.int64).tobytes())
        self.upto.frombytes(upto.tobytes())
        self.log.frombytes(value.tobytes())
        self.symbol.frombytes(symbol.astype(np.int64).tobytes())
        self.next.frombytes(np.where(last, -1, base + target).astype(np.int64).tobytes())
        firsts = (base + np.cumsum(sizes) - sizes).tolist()
        self.first.update(zip(short, firsts, strict=True))

    def add_long(self, chunk: str) -> int:
        """The same for one chunk of any length, a position at a time."""
        v, n = self.vocabulary, len(chunk)
        known, longest, base = v.log.get, v.longest, len(self.start)
        edges: list[list[tuple[int, float, int]]] = [[] for _ in range(n)]
        ending = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            here = edges[i]
            for j in range(i + 1, min(n, i + longest) + 1):
                if (p := known(chunk[i:j])) is not None:
                    here.append((p[0], p[1] + ending[j], j))
            if not here or here[0][2] > i + 1:
                here.append((v.size + ord(chunk[i]), BYTE_LOG + ending[i + 1], i + 1))
            if len(here) == 1:
                ending[i] = here[0][1]
            else:
                most = max(e[1] for e in here)
                ending[i] = most + math.log(sum(math.exp(e[1] - most) for e in here))
        for i, here in enumerate(edges):
            self.start.append(len(self.upto))
            total, row = 0.0, base + i
            for s, x, j in here:
                total += math.exp(x - ending[i])
                self.upto.append(row + total)
                self.log.append(x - ending[i])
                self.symbol.append(s)
                self.next.append(base + j if j < n else -1)
            self.upto[-1] = row + 1.0
        self.first[chunk] = base
        return base


class Sampler:
    def __init__(self, vocabulary: Vocabulary, k: int):
        self.vocabulary, self.k, self.lattices = vocabulary, k, Lattices(vocabulary)

    def sample(self, keys: list[str], texts: list[str | None], seed: int = 0) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """Per text up to k of (ids, log_prob, perturbed, inclusion), best first."""
        if len(self.lattices.upto) > KEPT_EDGES:
            self.lattices.clear()
        split, chunks, sizes = (CHUNK if self.vocabulary.joins else FINE_CHUNK).findall, [], []
        for t in texts:
            found = split(" " + t) if t else []
            chunks += found
            sizes.append(len(found))
        first = self.lattices.first
        self.lattices.add([c for c in dict.fromkeys(chunks) if c not in first])
        rows = [first[c] for c in chunks]
        n, counts = len(texts), np.array(sizes, dtype=np.int64)
        table = _Table(self.lattices)
        doc = np.repeat(np.arange(n), counts)
        begin = np.concatenate(([0], np.cumsum(counts)))
        seeds = np.array([xxhash.xxh64_intdigest(key.encode(), seed) for key in keys], dtype=np.uint64)
        rows0 = np.array(rows, dtype=np.int64)
        place = np.arange(len(rows0)) - begin[doc]
        everything = np.arange(len(rows0))
        draw = lambda number, at, state, step: table.walk(at, state, step, lambda a, s: uniform(seeds[doc[a]], number, place[a], s))

        top = -np.log(-np.log(uniform(seeds, 1 << 40)))  # the largest perturbed value of all segmentations
        paths = [draw(0, everything, rows0, np.zeros(len(rows0), dtype=np.int64))]
        drawn: list[list[list]] = [[[0, top[d]]] for d in range(n)]
        heaps: list[list[tuple]] = [[] for _ in range(n)]
        bound = top.copy()
        opened = [(0, frozenset())] * n  # per text: first decision that is free, and what is excluded there
        live = np.arange(n)
        for number in range(self.k):
            occ, step, edge = paths[number]
            self._split(table, heaps, number, live, opened, bound, occ, step, edge, doc, seeds, self.k - number)
            if number + 1 == self.k:
                break
            live, opened, kept_parts, at, state, at_step = self._open(table, paths, heaps, drawn, bound, number + 1, doc, begin, rows0, seeds)
            more = draw(number + 1, at, state, at_step)
            parts = [np.concatenate([x, y]) for x, y in zip(kept_parts, more, strict=True)]
            order = np.lexsort((parts[1], parts[0]))
            paths.append(tuple(p[order] for p in parts))
        out: list[list] = [[] for _ in range(n)]
        cut = [(np.searchsorted(doc[p[0]], np.arange(n + 1)), table.log[p[2]], table.symbol[p[2]]) for p in paths]
        for d in range(n):
            rest = -heaps[d][0][0] if heaps[d] else -math.inf
            for number, perturbed in drawn[d]:
                ends, log, symbol = cut[number]
                own = slice(ends[d], ends[d + 1])
                log_prob = float(log[own].sum())
                inclusion = 1.0 if rest == -math.inf else -math.expm1(-math.exp(min(log_prob - rest, 700.0)))
                out[d].append((self.vocabulary.symbols(symbol[own]), log_prob, float(perturbed), inclusion))
        return out

    def _split(self, table, heaps, number, live, opened, bound, occ, step, edge, doc, seeds, most) -> None:
        """Put on the heaps the sets that a drawn path leaves; only ``most`` can matter yet."""
        if not len(edge):
            return
        of, log = doc[occ], table.log[edge]
        ends = np.searchsorted(of, np.arange(len(heaps) + 1))
        before = np.concatenate(([0.0], np.cumsum(log)))
        prefix = before[:-1] - before[ends[of]]
        with np.errstate(divide="ignore"):
            left = np.log(np.maximum(-np.expm1(log), 0.0))
            mass = prefix + left
            free = np.zeros(len(edge), dtype=bool)
            for d in live:
                j, excluded = opened[d]
                a, b = ends[d], ends[d + 1]
                free[a + j : b] = True
                if excluded and a + j < b:
                    rest = table.rest(int(edge[a + j]), excluded | {int(edge[a + j])})
                    mass[a + j] = prefix[a + j] + (math.log(rest) if rest > 0 else -math.inf)
            mass[~free] = -np.inf
            plain = mass - np.log(-np.log(uniform(seeds[of], (1 << 41) + number, np.arange(len(edge)) - ends[of])))
            value = -np.logaddexp(-bound[of], -plain)
        value[np.isneginf(mass)] = -np.inf
        busy = np.flatnonzero(np.diff(ends) > 0)
        for _ in range(most):
            best = np.maximum.reduceat(value, ends[busy])
            if np.isneginf(best).all():
                break
            level = np.full(len(heaps), np.nan)
            level[busy] = best
            hit = np.flatnonzero((value == level[of]) & ~np.isneginf(value))
            _, one = np.unique(of[hit], return_index=True)
            for at in hit[one]:
                d = int(of[at])
                j = int(at - ends[d])
                excluded = opened[d][1] if j == opened[d][0] else frozenset()
                heapq.heappush(heaps[d], (-float(value[at]), number, j, tuple(excluded | {int(edge[at])})))
            value[hit[one]] = -np.inf

    def _open(self, table, paths, heaps, drawn, bound, number, doc, begin, rows0, seeds):
        """Take the best set of each text; returns the texts, where their freedom begins, the
        decisions they keep, and where to go on drawing."""
        live, opened = [], [(0, frozenset())] * len(heaps)
        keep: list[tuple] = []
        at, state, at_step = [], [], []
        starts = [np.searchsorted(doc[p[0]], np.arange(len(heaps) + 1)) for p in paths]
        for d, heap in enumerate(heaps):
            if not heap:
                continue
            value, source, j, excluded = heapq.heappop(heap)
            bound[d] = -value
            drawn[d].append([number, -value])
            live.append(d)
            opened[d] = (j, frozenset(excluded))
            occ, step, edge = paths[source]
            first = starts[source][d]
            u = float(uniform(seeds[d : d + 1], number, (1 << 42) + j)[0])
            chosen = table.among(int(edge[first + j]), opened[d][1], u)
            own = slice(first, first + j)
            keep.append((np.append(occ[own], occ[first + j]), np.append(step[own], step[first + j]), np.append(edge[own], chosen)))
            here = int(occ[first + j])
            if table.next[chosen] >= 0:
                at.append(np.array([here]))
                state.append(np.array([table.next[chosen]]))
                at_step.append(np.array([step[first + j] + 1]))
            later = np.arange(here + 1, begin[d + 1])
            at.append(later)
            state.append(rows0[later])
            at_step.append(np.zeros(len(later), dtype=np.int64))
        join = lambda xs: np.concatenate(xs) if xs else np.zeros(0, dtype=np.int64)
        kept = [join([k[c] for k in keep]) for c in range(3)]
        return np.array(live, dtype=np.int64), opened, kept, join(at), join(state), join(at_step)


class _Table:
    """The rows of ``Lattices`` as arrays."""

    def __init__(self, lattices: Lattices):
        # views; they go before rows are added
        view = lambda a, kind: np.frombuffer(a, dtype=kind) if len(a) else np.zeros(0, dtype=kind)
        self.start, self.symbol, self.next = (view(a, np.int64) for a in (lattices.start, lattices.symbol, lattices.next))
        self.upto, self.log = view(lattices.upto, np.float64), view(lattices.log, np.float64)

    def walk(self, at, state, step, draw):
        """Decisions (occurrence, step, edge) from the given states to the ends of the chunks."""
        found = []
        while len(at):
            edge = self.drawn(state, draw(at, step))
            found.append((at, step, edge))
            state = self.next[edge]
            on = state >= 0
            at, state, step = at[on], state[on], step[on] + 1
        if not found:
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
        flat = [np.concatenate([f[c] for f in found]) for c in range(3)]
        order = np.lexsort((flat[1], flat[0]))
        return tuple(x[order] for x in flat)

    def drawn(self, state: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each row that a number in (0, 1) falls on; rows are short, so from their
        first edge on."""
        edge, wanted, open_ = self.start[state], state + u, np.arange(len(state))
        while len(open_ := open_[self.upto[edge[open_]] <= wanted[open_]]):
            edge[open_] += 1
        return edge

    def edges(self, edge: int) -> range:
        """All edges of the row of one of them."""
        row = int(np.searchsorted(self.start, edge, side="right")) - 1
        return range(int(self.start[row]), int(self.start[row + 1]) if row + 1 < len(self.start) else len(self.upto))

    def rest(self, edge: int, excluded: frozenset | set) -> float:
        return math.fsum(math.exp(self.log[e]) for e in self.edges(edge) if e not in excluded)

    def among(self, edge: int, excluded: frozenset, u: float) -> int:
        left = [e for e in self.edges(edge) if e not in excluded]
        total = math.fsum(math.exp(self.log[e]) for e in left)
        for e in left:
            u -= math.exp(self.log[e]) / total
            if u <= 0:
                return e
        return left[-1]


_samplers: dict[tuple, Sampler] = {}


def sampler(model: str, k: int, sharpness: float) -> Sampler:
    """The sampler of this process."""
    key = (model, k, sharpness)
    if key not in _samplers:
        _samplers[key] = Sampler(Vocabulary(model, sharpness), k)
    return _samplers[key]


def sample_segmentations(df: DataFrame, model: str, k: int = 2, key: str = "doc_id", text: str = "text", sharpness: float = 1.0, seed: int = 0) -> DataFrame:
    """Rows (key, sample, ids, n_pieces, log_prob, perturbed, inclusion, round_trip), sample
    0 first. ``ids`` are little-endian unsigned 32-bit bytes; ``round_trip`` tells whether they
    decode to the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of small objects and no cycles
        try:
            yield from drawn(batches)
        finally:
            gc.enable()

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawer = sampler(model, k, sharpness)
        for whole in batches:
            texts, names = whole.column(1).to_pylist(), whole.column(2).to_pylist()
            at = 0
            while at < len(texts):
                upto, chars = at, 0
                while upto < len(texts) and upto - at < BATCH_DOCS and chars < BATCH_CHARS:
                    chars += len(texts[upto] or "")
                    upto += 1
                row, number, ids, logs, perturbed, inclusion, same = [], [], [], [], [], [], []
                for d, samples in enumerate(drawer.sample([x or "" for x in names[at:upto]], texts[at:upto], seed)):
                    plain = (texts[at + d] or "").encode("utf-8", "replace")
                    for s, (found, log_prob, value, score) in enumerate(samples):
                        row.append(at + d)
                        number.append(s)
                        ids.append(found.tobytes())
                        logs.append(log_prob)
                        perturbed.append(value)
                        inclusion.append(score)
                        same.append(drawer.vocabulary.decode(found) == plain)
                yield pa.RecordBatch.from_arrays(
                    [whole.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), *(pa.array(x, pa.float64()) for x in (logs, perturbed, inclusion)), pa.array(same, pa.bool_())],
                    names=[key, "sample", "ids", "n_pieces", "log_prob", "perturbed", "inclusion", "round_trip"],
                )
                at = upto

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, F.col(text).alias("t"), F.col(key).cast("string").alias("k")).mapInArrow(rows, f"`{key}` {kind}, sample int, ids binary, n_pieces long, log_prob double, perturbed double, inclusion double, round_trip boolean")


def decoded(df: DataFrame, model: str, ids: str = "ids", sharpness: float = 1.0) -> DataFrame:
    """``df`` with ``decoded``, the text of its ids; null for null ids."""
    @F.pandas_udf("string")
    def made(column: pd.Series) -> pd.Series:
        v = sampler(model, 1, sharpness).vocabulary
        return pd.Series([None if x is None else v.decode(np.frombuffer(x, dtype="<u4")).decode("utf-8", "replace") for x in column])

    return df.withColumn("decoded", made(ids))


def op4_segmentation_sampling(docs: DataFrame, model: str) -> DataFrame:
    drawn = sample_segmentations(docs, model)
    return drawn.select("doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", F.crc32("ids").alias("ids_crc32"), "round_trip")
