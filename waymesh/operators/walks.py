"""Searches over many small components at once, level by level, in arrays.

A task gets whole components as rows (component, id, source, target, cost, gain); a row without an id is
a start. A block of walks is one array a column; to go a hop further is to repeat its rows by their
ends' degrees. Blocks over ``BLOCK`` rows are cut up and wait on a stack, so memory is bounded by hops,
whatever the number of walks."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Walks that are taken a hop further at once; cells of best costs of the starts that are solved at once.
BLOCK, CELLS = 50_000, 2_000_000

BOUNDED = "start long, end long, path array<long>, edge_ids array<long>, total_km double, total_gain double, hops int, closed boolean"


class Network:
    """Edges by the node they leave: the ways of node k are ``first[k]`` to ``first[k + 1]``."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        rows = [b for b in batches if b.num_rows]
        whole = pa.Table.from_batches(rows).combine_chunks() if rows else None
        self.empty = whole is None
        if self.empty:
            return
        column = lambda c: whole.column(c).to_numpy()
        edge = whole.column(1).is_valid().to_numpy()
        source, target, part = column(2), column(3), column(0)
        self.nodes, at = np.unique(np.concatenate((source, target)), return_inverse=True)
        a, b = at[: len(source)], at[len(source) :]
        self.starts = np.unique(a[~edge])
        self.part = np.empty(len(self.nodes), dtype=np.int64)
        self.part[a], self.part[b] = part, part
        a, b, ids = a[edge], b[edge], whole.column(1).filter(whole.column(1).is_valid()).to_numpy()
        costs, gains = column(4)[edge], whole.column(5).to_numpy(zero_copy_only=False).astype(np.float64)[edge]
        loop = a == b
        leaves, to = np.concatenate((a, b[~loop])), np.concatenate((b, a[~loop]))
        order = np.argsort(leaves, kind="stable")
        both = lambda v: np.concatenate((v, v[~loop]))[order]
        self.to, self.ids, self.cost, self.gain = to[order], both(ids), both(costs), both(gains)
        self.first = np.searchsorted(leaves[order], np.arange(len(self.nodes) + 1))

    def ways(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For walks with these ends: the row that each next one continues, and its way."""
        n = self.first[ends + 1] - self.first[ends]
        row = np.repeat(np.arange(len(ends)), n)
        return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[ends], n)


def _rows(net: Network, path: list[np.ndarray], used: list[np.ndarray], km: np.ndarray, gain: np.ndarray, closed: np.ndarray) -> pa.RecordBatch:
    n, hops = len(km), len(used)
    lists = lambda c, k: pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k), pa.int32()), pa.array(np.stack(c, axis=1).ravel()))
    names = [net.nodes[p] for p in path]
    return pa.RecordBatch.from_arrays(
        [pa.array(names[0]), pa.array(names[-1]), lists(names, hops + 1), lists([net.ids[u] for u in used], hops), pa.array(km), pa.array(gain, from_pandas=True), pa.array(np.full(n, hops, dtype=np.int32)), pa.array(closed)],
        names=["start", "end", "path", "edge_ids", "total_km", "total_gain", "hops", "closed"],
    )


def _walks(net: Network, starts: np.ndarray, max_km: float, max_gain: float | None, max_hops: int, loops: bool, from_least: bool) -> Iterator[tuple]:
    """(path, used, km, gain, closed) of blocks of walks of one number of hops. ``from_least``: no node is
    less than the start."""
    stack = [([starts[k : k + BLOCK]], [], np.zeros(len(starts[k : k + BLOCK])), np.zeros(len(starts[k : k + BLOCK]))) for k in range(0, len(starts), BLOCK)][::-1]
    while stack:
        path, used, km, gain = stack.pop()
        row, way = net.ways(path[-1])
        far, high, to = km[row] + net.cost[way], gain[row] + net.gain[way], net.to[way]
        keep = far <= max_km
        if max_gain is not None:
            keep &= high <= max_gain
        if from_least:
            keep &= to >= path[0][row]
        keep = np.flatnonzero(keep)
        row, way, far, high, to = row[keep], way[keep], far[keep], high[keep], to[keep]
        closed, met = to == path[0][row], np.zeros(len(row), dtype=bool)
        for p in path[1:]:
            met |= p[row] == to
        if not loops or len(used) < 2:
            met |= closed
        else:
            # the edge that returns to the start may only be the first one
            met |= closed & (net.ids[used[0][row]] == net.ids[way])
        keep = np.flatnonzero(~met)
        row, way, far, high, closed = row[keep], way[keep], far[keep], high[keep], closed[keep]
        if not len(row):
            continue
        path, used = [*(p[row] for p in path), to[keep]], [*(u[row] for u in used), way]
        yield path, used, far, high, closed
        if len(used) < max_hops:
            on = np.flatnonzero(~closed)
            for k in range(0, len(on), BLOCK):
                few = on[k : k + BLOCK]
                stack.append(([p[few] for p in path], [u[few] for u in used], far[few], high[few]))


def bounded(max_km: float, max_gain: float, max_hops: int, loops: bool, least_hops: int) -> Callable:
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(batches)
        if net.empty:
            return
        for path, used, km, gain, closed in _walks(net, net.starts, max_km, max_gain, max_hops, loops, False):
            if len(used) >= least_hops:
                yield from _cut(_rows(net, path, used, km, gain, closed))

    return solve


def cycles(max_km: float, max_hops: int) -> Callable:
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(batches)
        if net.empty:
            return
        for path, used, km, gain, closed in _walks(net, np.arange(len(net.nodes)), max_km, None, max_hops, True, True):
            once = np.flatnonzero(closed & (path[1] < path[-2])) if len(used) >= 3 else ()
            if len(once):
                yield from _cut(_rows(net, [p[once] for p in path], [u[once] for u in used], km[once], gain[once], closed[once]))

    return solve


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, BLOCK):
        yield batch.slice(k, BLOCK)


def shortest(cutoff: float | None, max_rounds: int) -> Callable:
    """Rounds relax only what the last round made cheaper; a start has a cell for each node of its component."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(batches)
        if net.empty:
            return
        # nodes in the order of their components
        order = np.argsort(net.part, kind="stable")
        _, begins, sizes = np.unique(net.part[order], return_index=True, return_counts=True)
        place, begin, size = (np.empty(len(order), dtype=np.int64) for _ in range(3))
        place[order], begin[order], size[order] = np.arange(len(order)), np.repeat(begins, sizes), np.repeat(sizes, sizes)
        before = np.cumsum(size[net.starts]) - size[net.starts]
        for few in np.split(net.starts, np.flatnonzero(np.diff(before // CELLS)) + 1):
            base = np.cumsum(size[few]) - size[few] - begin[few]  # plus a node's place: its cell
            cost, hops = np.full(int(size[few].sum()), np.inf), np.zeros(int(size[few].sum()), dtype=np.int32)
            one, node = np.arange(len(few)), few
            cost[base + place[few]] = 0.0
            for hop in range(1, max_rounds + 1):
                row, way = net.ways(node)
                far = cost[base[one] + place[node]][row] + net.cost[way]
                at = base[one[row]] + place[net.to[way]]
                better = np.flatnonzero((far < cost[at]) & (far <= (np.inf if cutoff is None else cutoff)))
                if not len(better):
                    break
                by = better[np.lexsort((far[better], at[better]))]
                by = by[np.concatenate(([True], at[by][1:] != at[by][:-1]))]
                # a row that was made cheaper in the round before has as many hops as there were rounds
                cost[at[by]], hops[at[by]] = far[by], hop
                one, node = one[row[by]], net.to[way[by]]
            else:
                raise RuntimeError(f"costs didn't settle in {max_rounds} rounds")
            cell = np.flatnonzero(cost < np.inf)
            start = np.repeat(np.arange(len(few)), size[few])[cell]
            reached = order[cell - base[start]]
            rows = pa.RecordBatch.from_arrays([pa.array(net.nodes[few[start]]), pa.array(net.nodes[reached]), pa.array(cost[cell]), pa.array(hops[cell])], names=["start", "node", "cost", "hops"])
            yield from _cut(rows)

    return solve


# ---- routes that no better one resembles

#: Starts whose routes are held at once; routes of a component from which on only those that meet under a rare edge
#: are compared; rows and columns compared at once.
STARTS, MANY, TILE = 2_000, 6_000, 1_500


def _names(start: np.ndarray, used: np.ndarray, hops: np.ndarray) -> np.ndarray:
    """A route's name: the MD5 of its start and edges in order."""
    made = [hashlib.md5(f"{s}:{','.join(map(str, u[:n]))}".encode()).hexdigest() for s, u, n in zip(start.tolist(), used.tolist(), hops.tolist(), strict=True)]
    return np.array(made, dtype="S32")


def _beaten(edges: np.ndarray, hops: np.ndarray, score: np.ndarray, names: Callable[[np.ndarray], np.ndarray], least_percent: float) -> np.ndarray:
    """For routes as rows of ``edges`` (-1: none), each once: whether a better one, or an equal one of lesser name,
    shares ``least_percent`` or more of the longer one's. All are compared with all."""
    order = np.argsort(-score, kind="stable")
    rank, n = -score[order], len(order)
    m, inside = np.unique(edges, return_inverse=True)
    inside = inside.reshape(edges.shape)[order]
    beaten = np.zeros(n, dtype=bool)
    # the least number of edges to share, by a route's own
    sizes = np.arange(edges.shape[1] + 1)
    need = np.searchsorted(sizes * 100, sizes * least_percent).astype(np.float32)[hops[order]]

    def member(low: int, high: int) -> np.ndarray:
        made = np.zeros((high - low, len(m)), dtype=np.float32)
        np.put_along_axis(made, inside[low:high], 1.0, axis=1)
        if m[0] == -1:
            made[:, 0] = 0.0
        return made

    for low in range(0, n, TILE):
        high = min(low + TILE, n)
        one, ties = member(low, high), []
        for left in range(0, int(np.searchsorted(rank, rank[high - 1], side="right")), TILE):
            right = min(left + TILE, n)
            two = one if left == low else member(left, right)
            i, j = np.nonzero(one @ two.T >= np.maximum(need[low:high, None], need[None, left:right]))
            i, j = i + low, j + left
            beaten[i[rank[j] < rank[i]]] = True
            tied = (rank[j] == rank[i]) & (i != j) & ~beaten[i]
            ties.append((i[tied], j[tied]))
        i, j = (np.concatenate(c) for c in zip(*ties, strict=True))
        i, j = i[~beaten[i]], j[~beaten[i]]
        if len(i):
            asked, at = np.unique(np.concatenate((i, j)), return_inverse=True)
            called = names(order[asked])
            beaten[i[called[at[len(i) :]] < called[at[: len(i)]]]] = True
    out = np.empty(n, dtype=bool)
    out[order] = beaten
    return out


def beaten(edges: np.ndarray, hops: np.ndarray, score: np.ndarray, names: Callable[[np.ndarray], np.ndarray], least_percent: float) -> np.ndarray:
    """``_beaten``, for many routes list by list: two that share so many edges meet, with all edges in one order, rare
    ones first, under one of the first few of each."""
    if len(hops) < MANY:
        return _beaten(edges, hops, score, names, least_percent)
    kinds, at, uses = np.unique(edges, return_inverse=True, return_counts=True)
    place = np.empty(len(kinds), dtype=np.int64)
    place[np.argsort(uses, kind="stable")] = np.arange(len(kinds))
    at = np.where(edges < 0, len(kinds), place[at.reshape(edges.shape)])
    at.sort(axis=1)
    few = hops - np.ceil(hops * least_percent / 100 - 1e-9).astype(np.int64) + 1
    row, col = np.nonzero(np.arange(at.shape[1])[None, :] < np.minimum(few, hops)[:, None])
    by = np.argsort(at[row, col], kind="stable")
    out = np.zeros(len(hops), dtype=bool)
    for members in np.split(row[by], np.flatnonzero(np.diff(at[row, col][by])) + 1):
        # what is beaten may still beat others
        out[members] |= _beaten(edges[members], hops[members], score[members], lambda k, members=members: names(members[k]), least_percent)
    return out


ROUTES = "route_id string, start long, edge_ids array<long>, total_km double, total_gain double, similarity double"


def dissimilar(max_km: float, max_gain: float, max_hops: int, score: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], least_percent: float) -> Callable:
    """Of the walks that ``score`` (of km and gain: whether it is a route, and how good) takes as routes, those that no
    better one resembles. Routes that share an edge lie in one component, so none has to leave its task."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(batches)
        if net.empty:
            return
        starts = net.starts[np.argsort(net.part[net.starts], kind="stable")]
        ends = np.append(np.flatnonzero(np.diff(net.part[starts])) + 1, len(starts))
        low = 0
        while low < len(starts):
            # whole components: as many as have STARTS starts, one at least
            fit = ends[(ends > low) & (ends <= low + STARTS)]
            high = int(fit[-1] if len(fit) else ends[ends > low][0])
            yield from _routes_of(net, starts[low:high])
            low = high

    def _routes_of(net: Network, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        met = []
        for path, used, km, gain, _ in _walks(net, starts, max_km, max_gain, max_hops, True, False):
            taken, value = score(km, gain)
            at = np.flatnonzero(taken)
            if len(at):
                wide = np.full((len(at), max_hops), -1, dtype=np.int64)
                for k, u in enumerate(used):
                    wide[:, k] = net.ids[u[at]]
                met.append((path[0][at], wide, np.full(len(at), len(used), dtype=np.int64), km[at], gain[at], value[at]))
        if not met:
            return
        start, used, hops, km, gain, value = (np.concatenate(c) for c in zip(*met, strict=True))
        names = lambda k: _names(net.nodes[start[k]], used[k], hops[k])
        order = np.argsort(net.part[start], kind="stable")
        left = []
        for rows in np.split(order, np.flatnonzero(np.diff(net.part[start[order]])) + 1):
            left.append(rows[~beaten(used[rows], hops[rows], value[rows], lambda k, rows=rows: names(rows[k]), least_percent)])
        kept = np.concatenate(left)
        for k in range(0, len(kept), BLOCK):
            few = kept[k : k + BLOCK]
            offsets = np.concatenate(([0], np.cumsum(hops[few]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(used[few][np.arange(max_hops)[None, :] < hops[few][:, None]]))
            columns = [pa.array([x.decode() for x in names(few)]), pa.array(net.nodes[start[few]]), lists, pa.array(km[few]), pa.array(gain[few]), pa.array(value[few])]
            yield pa.RecordBatch.from_arrays(columns, names=["route_id", "start", "edge_ids", "total_km", "total_gain", "similarity"])

    return solve


# ---- k shortest paths

def _rests(ways: list, goal: int) -> dict[int, float]:
    """Least cost from every node that reaches the goal."""
    heap, done = [(0.0, goal)], {}
    while heap:
        cost, at = heapq.heappop(heap)
        if at not in done:
            done[at] = cost
            for to, km, _ in ways[at]:
                if to not in done:
                    heapq.heappush(heap, (cost + km, to))
    return done


def _least(ways: list, rest: dict, start: int, goal: int, banned_nodes: set, banned_edges: set) -> float | None:
    """Cost of a cheapest path; ``rest`` leads the search."""
    heap, done = [(rest[start], 0.0, start)], set()
    while heap:
        _, cost, at = heapq.heappop(heap)
        if at == goal:
            return cost
        if at not in done:
            done.add(at)
            for to, km, i in ways[at]:
                if to not in done and to not in banned_nodes and i not in banned_edges:
                    heapq.heappush(heap, (cost + km + rest[to], cost + km, to))
    return None


def _cheapest(ways: list, rest: dict, start: int, goal: int, bound: float, banned_nodes: set, banned_edges: set) -> tuple[float, list[int], list[int]]:
    """(cost, nodes, edges) of a cheapest path, ties by node and edge ids; what can't be part of one is not looked at."""
    heap, done = [(0.0, (start,), ())], set()
    while True:
        cost, path, used = heapq.heappop(heap)
        at = path[-1]
        if at == goal:
            return cost, list(path), list(used)
        if at in done:
            continue
        done.add(at)
        for to, km, i in ways[at]:
            if cost + km + rest[to] <= bound and to not in done and to not in banned_nodes and i not in banned_edges:
                heapq.heappush(heap, (cost + km, (*path, to), (*used, i)))


def _slack(cost: float) -> float:
    """Sums of the same edges from either end differ by less."""
    return 1e-9 * (1.0 + abs(cost))


def k_cheapest(ways: list, start: int, goal: int, k: int) -> list[tuple[float, list[int], list[int]]]:
    """Loopless paths in order of cost. A path deviates from the one it came from no earlier than that did; where
    enough candidates are cheaper than any deviation there can be, it isn't searched for."""
    rest = _rests(ways, goal)
    if start not in rest:
        return []
    kms = {i: km for at in rest for _, km, i in ways[at]}
    found, since, candidates = [_cheapest(ways, rest, start, goal, rest[start] + _slack(rest[start]), set(), set())], 0, []
    while len(found) < k:
        _, nodes, used = found[-1]
        before = sum(kms[i] for i in used[:since])
        for j in range(since, len(nodes) - 1):
            before += kms[used[j - 1]] if j > since else 0.0
            banned = {p[2][j] for p in found if len(p[2]) > j and p[2][:j] == used[:j]}
            passed = set(nodes[:j])
            open_ = [km + rest[to] for to, km, i in ways[nodes[j]] if i not in banned and to not in passed]
            wanted = k - len(found)
            if not open_ or (len(candidates) >= wanted and before + min(open_) > (most := heapq.nsmallest(wanted, candidates)[-1][0]) + _slack(most)):
                continue
            least = _least(ways, rest, nodes[j], goal, passed, banned)
            if least is not None:
                _, tail, by = _cheapest(ways, rest, nodes[j], goal, least + _slack(least), passed, banned)
                by = used[:j] + by
                heapq.heappush(candidates, (sum(kms[i] for i in by), nodes[:j] + tail, by, j))
        if not candidates:
            break
        cost, nodes, used, since = heapq.heappop(candidates)
        found.append((cost, nodes, used))
    return found


PATHS = "start long, goal long, path_id int, path array<long>, edge_ids array<long>, cost double"


def k_shortest(k: int) -> Callable:
    """Rows (component, id, source, target, cost); a row without an id asks for the way from its source to its target."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        whole = pa.Table.from_batches(rows).combine_chunks()
        edge = whole.column(1).is_valid().to_numpy()
        source, target, part = (whole.column(c).to_numpy() for c in (2, 3, 0))
        asked = sorted(set(zip(source[~edge].tolist(), target[~edge].tolist(), strict=True)))
        edge &= np.isin(part, part[~edge])
        nodes, at = np.unique(np.concatenate((source[edge], target[edge])), return_inverse=True)
        a, b = at[: edge.sum()], at[edge.sum() :]
        ids, costs = whole.column(1).filter(pa.array(edge)).to_numpy(), whole.column(4).to_numpy()[edge]
        leaves, to, km, by = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((costs, costs)), np.concatenate((ids, ids))
        order = np.lexsort((by, km, to, leaves))
        each = list(zip(to[order].tolist(), km[order].tolist(), by[order].tolist(), strict=True))
        first = np.searchsorted(leaves[order], np.arange(len(nodes) + 1)).tolist()
        ways = [each[first[v] : first[v + 1]] for v in range(len(nodes))]
        place, names, out = {n: v for v, n in enumerate(nodes.tolist())}, nodes.tolist(), []
        for s, g in asked:
            if s in place and g in place:
                for n, (cost, path, used) in enumerate(k_cheapest(ways, place[s], place[g], k)):
                    out.append((s, g, n + 1, [names[v] for v in path], used, cost))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.float64())
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield from _cut(pa.RecordBatch.from_arrays(made, names=["start", "goal", "path_id", "path", "edge_ids", "cost"]))

    return solve
